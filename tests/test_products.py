"""From CSV feeds to gold tables, on disk."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.operators.quality import ContractViolation
from perispark.plans import labs, products, reports
from perispark.plans.icu import features_for_case
from perispark.sources.lake import Lake
from tests.conftest import rows

VITALS = """Case_ID,Time,Solar8000/HR,Solar8000/PLETH_HR,Primus/AWP,BIS/SQI
1,0,60,61,5,90
1,1,60,62,-5,
1,2,0,61,5,91
2,0,70,,5,
"""
LABS = """caseid,dt,name,result
1,-10,hb,12
1,-5,hb,13
1,5,hb,10
1,6,plt,200
1,7,gluc,bad
2,-1,hb,0
2,1,hb,4
"""
PATIENTS = """caseid,subjectid,age,sex,height,weight,bmi,asa,department,optype,dx,opname,approach,ane_type,icu_days
1,11,50,m,170,70,24,2,General surgery,a,d,o,Open,General,0
2,12,60,f,160,60,23,1,Urology,a,d,o,Open,Spinal,3
3,13,200,f,160,60,23,1,Urology,a,d,o,Open,Spinal,3
"""


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    for name, text in (("vitals", VITALS), ("labs", LABS), ("patients", PATIENTS)):
        (folder / f"{name}.csv").write_text(text)
    lake = Lake(spark, str(folder / "lake"))
    assert products.ingest_vitals(lake, str(folder / "vitals.csv"))
    assert products.ingest_labs(lake, str(folder / "labs.csv"))
    assert products.ingest_patients(lake, str(folder / "patients.csv"))
    assert not products.ingest_patients(lake, str(folder / "patients.csv"))
    products.build_silver(lake)
    products.build_gold(lake)
    return lake


def test_silver(lake):
    clean = lake.read("silver", "vitals_clean")
    assert clean.count() == 4 and clean.where("solar8000_hr IS NULL").count() == 1
    assert rows(lake.read("silver", "vitals_quarantine").select("sensor_name", "original_value")) == [("primus_awp", -5.0), ("solar8000_hr", 0.0)]
    results = lake.read("silver", "labs_results_classified")
    assert results.count() == 6 and results.where("is_most_recent").count() == 5
    assert lake.read("silver", "labs_quarantine").count() == 1
    assert rows(lake.read("silver", "patients_demographics").select("caseid", "sex")) == [(1, "M"), (2, "F")]
    assert lake.read("silver", "patients_quarantine").count() == 1
    assert lake.read("silver", "sensors_metadata").count() == 30
    assert lake.read("silver", "labs_metadata_limits").count() == 5


def test_gold(lake):
    health = lake.read("gold", "sensor_health_summary")
    assert health.where("case_id = 1").count() == 4
    frozen = health.where("sensor_name = 'solar8000_hr' AND case_id = 1").first()
    assert frozen.frozen_signal_count == 1 and frozen.hardware_failures == 0
    assert lake.read("gold", "cross_sensor_drift").count() == 2
    assert lake.read("gold", "hardware_failures_summary").count() == 2
    assert lake.read("gold", "view_window").count() == 6
    assert lake.read("gold", "sensor_uptime_rates").count() == 6
    impact = {r.caseid: r for r in lake.read("gold", "pre_vs_post_operation").collect()}
    assert impact[1].pre_op_avg == 12.5 and impact[1].percent_delta == -20.0
    assert impact[2].percent_delta == float("inf")
    features = lake.read("gold", "icu_ml_features")
    assert features_for_case(features, 1).first().preop_hb == 13.0
    with pytest.raises(ValueError, match="caseid=99"):
        features_for_case(features, 99)


def test_rerun_gives_the_same_tables(lake):
    before = rows(lake.read("silver", "labs_results_classified"))
    products.build_labs(lake)
    assert rows(lake.read("silver", "labs_results_classified")) == before


def test_a_missing_time_stops_the_pipeline(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    (tmp_path / "v.csv").write_text("Case_ID,Time,Solar8000/HR\n1,,60\n1,5,60\n")
    products.ingest_vitals(lake, str(tmp_path / "v.csv"))
    with pytest.raises(ContractViolation, match="time"):
        products.build_vitals(lake)
    assert not lake.exists("silver", "vitals_clean")


def test_percent_delta_edges(spark):
    data = [(1, 0.0, 0.0), (2, 0.0, 5.0), (3, 4.0, 2.0), (4, 4.0, None)]
    labs_df = spark.createDataFrame([(c, "hb", p, v) for c, a, b in data for p, v in (("PRE_OP", a), ("POS_OP", b))],
                                    "caseid long, name string, surgery_phase string, result double")
    patients = spark.createDataFrame([(i,) for i in range(5)], "caseid long")
    got = {r.caseid: r.percent_delta for r in labs.pre_vs_post(labs_df, patients, patients).collect()}
    assert got == {1: None, 2: float("inf"), 3: -50.0}


def test_latest_instead_of_mean(spark):
    labs_df = spark.createDataFrame([(1, "hb", "PRE_OP", -2.0, 10.0), (1, "hb", "PRE_OP", -1.0, 14.0), (1, "hb", "POS_OP", 1.0, 7.0)],
                                    "caseid long, name string, surgery_phase string, dt double, result double")
    patients = spark.createDataFrame([(1,)], "caseid long")
    assert labs.pre_vs_post(labs_df, patients, patients, method="latest").first().pre_op_avg == 14.0
    with pytest.raises(ValueError):
        labs.pre_vs_post(labs_df, patients, patients, method="median")


HEALTH = [(1, "a", "X", 50.0, 5, 1, 0, fv.GRADE_CRITICAL), (1, "b", "X", 12.0, 1, 1, 9, fv.GRADE_DEGRADED), (2, "c", "Y", 0.0, 99, 9, 9, fv.GRADE_EXCELLENT)]


def test_reports(spark):
    health = spark.createDataFrame(HEALTH, "case_id long, sensor_name string, equipment_brand string, null_rate_percentage double, "
                                           "frozen_signal_count long, noise_spikes_count long, hardware_failures long, health_grade string")
    assert [r.sensor_name for r in reports.noisiest_sensors(health).collect()] == ["b", "a"]
    assert [r.sensor_name for r in reports.noisiest_sensors(health, "Y").collect()] == []
    assert [r.sensor_name for r in reports.intervention_list(health).collect()] == ["a", "c", "b"]
    assert reports.grade_distribution(health, ["X"]).count() == 2
    failures = spark.createDataFrame([("X", "r1", 1), ("X", "r2", 2), ("Y", "r1", 5)], "equipment_brand string, error_reason string, failure_count long")
    assert rows(reports.failures_by_brand(failures).select("equipment_brand", "error_reason", "failure_pct")) == [
        ("X", "r1", 33.33), ("X", "r2", 66.67), ("Y", "r1", 100.0)]
    empty = reports.impact_kpis(spark.createDataFrame([], "caseid long, age double, icu_days double, lab_test string")).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0)


def test_streaming_input(spark, tmp_path):
    """Row-local operators take a streaming frame as it is."""
    from perispark.operators.filters import BoundsRule, run_filters

    source = str(tmp_path / "in")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 0.0), (1, dt.datetime(2024, 1, 1), 5.0)], "case_id long, time timestamp_ntz, x double")
    df.write.parquet(source)
    log = run_filters(spark.readStream.schema(df.schema).parquet(source), [BoundsRule(["x"], 0)])[1]
    query = log.writeStream.format("memory").queryName("log").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination(60)
    assert spark.table("log").select(F.count("*")).first()[0] == 1
