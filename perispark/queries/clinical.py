"""Laboratory, feature-table and impact-dashboard queries, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.functions.columns import binary_target
from perispark.ml.metrics import class_balance as count_classes
from perispark.ml.prep import active_features as find_active
from perispark.operators import reshape
from perispark.plans import icu, reports
from perispark.plans.labs import pre_vs_post as build_pre_vs_post
from perispark.queries import fixtures as fx
from perispark.queries.cleaning import DEMOGRAPHICS_SQL, LABS_RESULTS_SQL, SURGERY_SQL, labs, patients
from perispark.queries.registry import Registry, settle, settled
from perispark.sources.dims import lab_limits

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles

# ---- laboratory ----
LIMITS_SQL = """SELECT * FROM (VALUES ('hb', 13.0, 17.0, 'g/dL'), ('plt', 130.0, 400.0, 'x1000/mcL'), ('wbc', 4.0, 10.0, 'x1000/mcL'),
 ('gluc', 70.0, 110.0, 'mg/dL'), ('cr', 0.7, 1.4, 'mg/dL')) AS d(name, min_normal, max_normal, unit)"""


@query(f"""SELECT l.name, CAST(min_normal AS DOUBLE) AS min_normal, CAST(max_normal AS DOUBLE) AS max_normal, unit, results
 FROM (SELECT name, count(*) AS results FROM ({fx.LABS_RAW_SQL}) GROUP BY name) l LEFT JOIN ({LIMITS_SQL}) d ON l.name = d.name""")
def dim_lab_limits(spark, sf):
    """Which observed tests the reference ranges cover."""
    counted = fx.labs_raw(spark, sf).groupBy("name").agg(F.count(F.lit(1)).alias("results"))
    return counted.join(lab_limits(spark), "name", "left").select("name", "min_normal", "max_normal", "unit", "results")


@query(f"""SELECT caseid, name, surgery_phase, {settle("avg(result)", 6)} AS result FROM ({LABS_RESULTS_SQL}) GROUP BY caseid, name, surgery_phase""")
def lab_phase_avg(spark, sf):
    return settled(reshape.lab_phase_avg(labs(spark, sf)[0]), "result", digits=6)


IMPACT_SQL = f"""SELECT p.*, d.* EXCLUDE (caseid), s.* EXCLUDE (caseid) FROM (SELECT *, pos_op_avg - pre_op_avg AS absolute_delta,
 CASE WHEN pre_op_avg <> 0 THEN (pos_op_avg - pre_op_avg) / pre_op_avg * 100 WHEN pos_op_avg > pre_op_avg THEN CAST('inf' AS DOUBLE)
 WHEN pos_op_avg < pre_op_avg THEN CAST('-inf' AS DOUBLE) END AS percent_delta FROM (SELECT caseid, name AS lab_test,
 avg(CASE WHEN surgery_phase = 'PRE_OP' THEN result END) AS pre_op_avg, avg(CASE WHEN surgery_phase = 'POS_OP' THEN result END) AS pos_op_avg
 FROM ({LABS_RESULTS_SQL}) GROUP BY caseid, name) WHERE pre_op_avg IS NOT NULL AND pos_op_avg IS NOT NULL) p
 JOIN ({DEMOGRAPHICS_SQL}) d ON p.caseid = d.caseid JOIN ({SURGERY_SQL}) s ON p.caseid = s.caseid"""


def impact(spark, sf):
    demographics, surgery, _ = patients(spark, sf)
    return build_pre_vs_post(labs(spark, sf)[0], demographics, surgery)


@query(f"""SELECT * REPLACE ({settle("pre_op_avg", 6)} AS pre_op_avg, {settle("pos_op_avg", 6)} AS pos_op_avg, {settle("absolute_delta", 6)} AS absolute_delta,
 {settle("percent_delta")} AS percent_delta) FROM ({IMPACT_SQL})""")
def pre_vs_post(spark, sf):
    return settled(settled(impact(spark, sf), "pre_op_avg", "pos_op_avg", "absolute_delta", digits=6), "percent_delta")


# ---- features ----
FEATURES_SQL = f"""SELECT d.caseid, age, sex, bmi, asa, department, optype, approach, ane_type, preop_hb, preop_plt, preop_wbc, preop_gluc,
 preop_cr, preop_alb, icu_days FROM ({DEMOGRAPHICS_SQL}) d JOIN ({SURGERY_SQL}) s ON d.caseid = s.caseid LEFT JOIN (SELECT caseid, {", ".join(
    f"max(CASE WHEN name = '{n}' THEN result END) AS preop_{n}" for n in fv.PREOP_LABS)} FROM ({LABS_RESULTS_SQL})
 WHERE surgery_phase = 'PRE_OP' AND is_most_recent GROUP BY caseid) l ON d.caseid = l.caseid WHERE icu_days IS NOT NULL"""


def features(spark, sf):
    demographics, surgery, _ = patients(spark, sf)
    return icu.icu_features(demographics, surgery, labs(spark, sf)[0])


@query(FEATURES_SQL)
def icu_features(spark, sf):
    return features(spark, sf)


@query(f"SELECT * FROM ({FEATURES_SQL}) WHERE caseid = (SELECT max(caseid) FROM ({FEATURES_SQL}))")
def case_lookup(spark, sf):
    table = features(spark, sf)
    return table.where(F.col("caseid") == table.agg(F.max("caseid")).scalar())


@query(f"SELECT caseid, age, bmi, asa, preop_hb, preop_plt, preop_wbc, preop_gluc, icu_days FROM ({FEATURES_SQL})")
def active_features(spark, sf):
    known, active = find_active(features(spark, sf), fv.NUMERIC_FEATURES, fv.ICU_TARGET)
    return known.select("caseid", *active, fv.ICU_TARGET)


@query(f"SELECT CAST(icu_days > 0 AS INTEGER) AS needs_icu, count(*) AS n FROM ({FEATURES_SQL}) GROUP BY 1")
def class_balance(spark, sf):
    return count_classes(features(spark, sf).select(binary_target(fv.ICU_TARGET).alias("needs_icu")), "needs_icu")


# ---- impact dashboard ----
LABELLED_SQL = f"""SELECT * REPLACE (CASE lower(department) WHEN 'general surgery' THEN 'Cirurgia Geral' WHEN 'gynecology' THEN 'Ginecologia'
 WHEN 'thoracic surgery' THEN 'Cirurgia Torácica' WHEN 'urology' THEN 'Urologia' ELSE department END AS department) FROM ({IMPACT_SQL})"""
KPIS = """SELECT count(DISTINCT caseid) AS patients, coalesce(round(avg(age), 1), 0.0) AS mean_age,
 coalesce(round(avg(icu_days), 1), 0.0) AS mean_icu_days, count(DISTINCT lab_test) AS lab_tests"""


def labelled(spark, sf):
    return reports.label_departments(impact(spark, sf))


@query(f"{KPIS} FROM ({LABELLED_SQL})")
def impact_kpis(spark, sf):
    return reports.impact_kpis(labelled(spark, sf))


@query(f"{KPIS} FROM ({LABELLED_SQL}) WHERE department = 'Urologia' AND lab_test = 'hb'")
def impact_kpis_filtered(spark, sf):
    return reports.impact_kpis(reports.filter_impact(labelled(spark, sf), "Urologia", "hb"))


@query(f"""SELECT lab_test, upper(lab_test) AS code, CASE lab_test WHEN 'hb' THEN 'Hemoglobina (Transporte de Oxigénio/Perda de Sangue)'
 WHEN 'plt' THEN 'Plaquetas (Capacidade de Coagulação)' WHEN 'wbc' THEN 'Glóbulos Brancos (Resposta do Sistema Imunitário)'
 WHEN 'gluc' THEN 'Glicose (Nível de Açúcar/Stress Metabólico)' WHEN 'na' THEN 'Sódio (Equilíbrio de Líquidos e Pressão)' END AS label,
 {settle("avg(absolute_delta)")} AS mean_delta FROM ({LABELLED_SQL}) GROUP BY lab_test""")
def impact_by_test(spark, sf):
    return settled(reports.impact_by_test(labelled(spark, sf)), "mean_delta")


@query(f"SELECT lab_test, sex, {settle("avg(absolute_delta)")} AS mean_delta FROM ({LABELLED_SQL}) WHERE sex IS NOT NULL GROUP BY lab_test, sex")
def impact_by_sex(spark, sf):
    return settled(reports.impact_by_sex(labelled(spark, sf)), "mean_delta")


@query(f"""SELECT department, sex, {settle("avg(absolute_delta)")} AS mean_delta FROM ({LABELLED_SQL}) WHERE sex IS NOT NULL AND lab_test = 'plt'
 GROUP BY department, sex""")
def impact_by_sex_department(spark, sf):
    return settled(reports.impact_by_sex(reports.filter_impact(labelled(spark, sf), lab_test="plt"), "department"), "mean_delta")


@query(f"""SELECT department, {settle("avg(pre_op_avg)")} AS mean_pre, {settle("avg(pos_op_avg)")} AS mean_post FROM ({LABELLED_SQL})
 WHERE lab_test = 'plt' GROUP BY department""")
def impact_by_department(spark, sf):
    chosen = reports.filter_impact(labelled(spark, sf), lab_test="plt")
    return settled(reports.impact_by_department(chosen), "mean_pre", "mean_post")
