import datetime as dt

import pytest
from pyspark.sql import functions as F

from perispark.contracts import CONTRACTS
from perispark.operators import quality as q
from perispark.operators import upsert as up
from perispark.sources.csv import read_csv_feed, read_or_fallback, with_audit
from perispark.sources.lake import Lake, cluster_for_cases
from tests.conftest import rows

PATIENTS = "caseid long, subjectid long, age double, sex string, source_system string"


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


# ---- upsert ----
CURRENT = [(1, 1, 10.0, "M", "old"), (2, 2, 20.0, None, "old"), (3, 3, 30.0, "F", "old"), (None, 4, 40.0, "F", "old"), (6, 6, 1.0, "M", "old")]
BATCH = [(1, 1, 10.0, "M", "new"), (2, 2, 20.0, "M", "new"), (3, 3, 30.0, None, "new"), (None, 4, 41.0, "F", "new"), (5, 5, 50.0, "M", "new")]


def test_upsert_paths(spark):
    current, batch = spark.createDataFrame(CURRENT, PATIENTS), spark.createDataFrame(BATCH, PATIENTS)
    got = rows(up.upsert(current, batch))
    assert got == sorted([CURRENT[0], BATCH[1], BATCH[2], BATCH[3], BATCH[4], CURRENT[4]], key=lambda t: [(x is not None, str(type(x)), x) for x in t])
    again = up.upsert(up.upsert(current, batch), batch)
    assert rows(again) == got
    log = rows(up.change_log(current, batch))
    assert log == [(None, 4, "age", "40.0", "41.0"), (2, 2, "sex", None, "M"), (3, 3, "sex", "F", None)]


def test_upsert_edges(spark):
    current = spark.createDataFrame(CURRENT, PATIENTS)
    assert rows(up.upsert(current, current.where("false"))) == rows(current)
    assert rows(up.upsert(current.where("false"), current)) == rows(current)
    assert up.change_log(current, current).count() == 0
    wider = current.withColumn("extra", F.lit("x"))
    assert up.upsert(current, wider).where("extra = 'x'").count() == len(CURRENT)


def test_lake_upsert(spark, lake):
    current, batch = spark.createDataFrame(CURRENT, PATIENTS), spark.createDataFrame(BATCH, PATIENTS)
    assert lake.upsert(current, "bronze", "patients")
    assert lake.current("bronze", "patients")[0] == 1
    assert not lake.upsert(current.withColumn("source_system", F.lit("later")), "bronze", "patients")
    assert lake.current("bronze", "patients")[0] == 1
    assert lake.upsert(batch, "bronze", "patients")
    assert lake.current("bronze", "patients")[0] == 2
    assert rows(lake.read("bronze", "patients")) == rows(up.upsert(current, batch))
    with pytest.raises(ValueError, match="repeats"):
        lake.upsert(batch.union(batch), "bronze", "patients")
    changed = batch.withColumn("age", F.col("age") + 1)
    ordered = batch.withColumn("n", F.lit(1)).union(changed.withColumn("n", F.lit(2)))
    assert lake.upsert(ordered, "bronze", "patients", order=["n"])
    assert lake.read("bronze", "patients").where("caseid = 5").first().age == 51.0


# ---- lake ----
def test_write_modes(spark, lake):
    df = spark.range(10).toDF("x")
    with pytest.raises(FileNotFoundError):
        lake.read("silver", "t")
    assert lake.write(df, "silver", "t")
    assert lake.write(lake.read("silver", "t").where("x < 5"), "silver", "t")
    assert lake.write(df.where("x = 9"), "silver", "t", mode="append")
    assert rows(lake.read("silver", "t")) == [(i,) for i in (0, 1, 2, 3, 4, 9)]
    assert not lake.write(df.where("x > 100"), "silver", "t")
    assert lake.read("silver", "t").count() == 6
    assert lake.write(df.where("x > 100"), "silver", "t", skip_empty=False)
    assert lake.read("silver", "t").count() == 0
    with pytest.raises(ValueError, match="mode"):
        lake.write(df, "silver", "t", mode="merge")


def test_broken_contract_publishes_nothing(spark, lake):
    contract = q.Contract("c", (q.Rule("no_nulls(x)"),))
    good, bad = spark.range(3).toDF("x"), spark.createDataFrame([(1,), (None,)], "x long")
    with pytest.raises(q.ContractViolation, match="1 null values"):
        lake.write(bad, "gold", "t", contract=contract)
    assert not lake.exists("gold", "t")
    lake.write(good, "gold", "t", contract=contract)
    with pytest.raises(q.ContractViolation):
        lake.write(bad, "gold", "t", mode="append", contract=contract)
    assert lake.read("gold", "t").count() == 3


def test_position_is_a_total_order(spark, lake):
    lake.write(spark.range(50).repartition(3), "bronze", "t")
    lake.write(spark.range(50), "bronze", "t", mode="append")
    df = lake.read("bronze", "t", position=True)
    assert df.select("_file", "_row").distinct().count() == 100


def test_layout(spark, lake):
    df = spark.range(100).select((F.col("id") % 2).alias("case_id"), F.timestamp_seconds(F.col("id") * 7200).cast("timestamp_ntz").alias("time"))
    assert cluster_for_cases(df, 8).count() == 100


# ---- csv ----
def test_csv(spark, tmp_path):
    path = tmp_path / "feed.csv"
    path.write_text("Case_ID,Time,Solar8000/HR,Empty,Note\n1,0.5,60,,a\n2,,NaN,,\n")
    df = read_csv_feed(spark, str(path))
    assert dict(df.dtypes)["Empty"] == "string"
    assert rows(df.select("Case_ID", "Time", "`Solar8000/HR`")) == [(1, 0.5, 60.0), (2, None, None)]
    kept = read_csv_feed(spark, str(path), keep_empty_text=True)
    assert [r.Note for r in kept.orderBy("Case_ID").collect()] == ["a", ""]
    audited = with_audit(df, "VitalDB", dt.datetime(2024, 1, 1))
    assert audited.select("ingest_time", "source_system").distinct().collect() == [(dt.datetime(2024, 1, 1), "VitalDB")]
    assert with_audit(df, "x").select("ingest_time").distinct().count() == 1


def test_fallback(spark, lake, tmp_path):
    path = tmp_path / "sample.csv"
    path.write_text("case_id,time,hr\n1,2024-01-01 00:00:00,60\n1,nonsense,61\n")
    read = lambda: lake.read("silver", "vitals")
    df = read_or_fallback(spark, read, str(path))
    assert sorted(r.ts is None for r in df.collect()) == [False, True]
    with pytest.raises(FileNotFoundError):
        read_or_fallback(spark, read, str(tmp_path / "absent.csv"))
    empty = tmp_path / "empty.csv"
    empty.write_text("case_id,time\n")
    with pytest.raises(ValueError):
        read_or_fallback(spark, read, str(empty))

    def broken():
        raise RuntimeError("disk")

    with pytest.raises(RuntimeError, match="disk"):
        read_or_fallback(spark, broken, str(path))
    lake.write(spark.range(1), "silver", "vitals")
    assert read_or_fallback(spark, read, str(path)).columns == ["id"]


# ---- contracts ----
DOC = {
    "contract": {"id": "demo"},
    "schema": [{"name": "a", "type": "integer", "nullable": False}],
    "quality": {"constraints": [
        {"rule": "no_nulls(a, gone)", "severity": "error"},
        {"rule": "is_unique(a)", "severity": "warning"},
        {"rule": "a BETWEEN 0 AND 5 OR a IS NULL", "severity": "error"},
        {"rule": "a IN (SELECT DISTINCT k FROM bronze.known)", "severity": "warning"},
        {"rule": "schema_allows_additional_columns", "severity": "info"},
    ]},
}


def test_contract_layouts(tmp_path):
    a = q.Contract.from_dict(DOC)
    b = q.Contract.from_dict({**DOC, "schema": {"fields": DOC["schema"]}})
    assert a == b and a.fields == (("a", "integer", False),)
    assert [r.kind for r in a.rules] == ["no_nulls", "unique", "predicate", "reference", "info"]
    path = tmp_path / "c.yaml"
    path.write_text("contract: {id: demo}\nquality:\n  constraints:\n    - rule: \"no_nulls(a)\"\n      severity: error\n")
    pytest.importorskip("yaml")
    assert q.Contract.load(str(path)).rules == (q.Rule("no_nulls(a)", "error"),)


def test_report_and_gate(spark):
    df = spark.createDataFrame([(1,), (1,), (9,), (None,)], "a long")
    known = spark.createDataFrame([(1,)], "k long")
    contract = q.Contract.from_dict(DOC)
    report = q.contract_report(df, contract, tables=lambda name: known)
    got = {(r.rule, r.column_name): (r.severity, r.violations) for r in report.collect()}
    assert got == {
        ("no_nulls(a, gone)", "a"): ("error", 1), ("no_nulls(a, gone)", "gone"): ("error", 1), ("is_unique(a)", "a"): ("warning", 1),
        ("a BETWEEN 0 AND 5 OR a IS NULL", None): ("error", 1),
        ("a IN (SELECT DISTINCT k FROM bronze.known)", "a"): ("warning", 1)}
    with pytest.raises(q.ContractViolation, match="gone"):
        q.quality_gate(df, contract)
    fine = df.where("a = 1").withColumn("gone", F.lit(1))
    assert q.quality_gate(fine, contract) is fine
    assert q.quality_gate(fine, contract, enforce="all", tables=lambda name: known) is fine  # repeated keys only warn
    with pytest.raises(q.ContractViolation, match="BETWEEN"):
        q.quality_gate(df.where("a = 9").withColumn("gone", F.lit(1)), contract, enforce="all", tables=lambda name: known)


def test_null_and_predicate_rules_share_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "a long, b double").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    contract = q.Contract("c", (q.Rule("no_nulls(a, b)"), q.Rule("a > 0"), q.Rule("b < 5")))
    plan = q.contract_report(df, contract)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(float("nan"),)], "a double")
    assert q.contract_report(df, q.Contract("c", (q.Rule("no_nulls(a)"),))).first().violations == 1


def test_time_rule_and_empty_contract(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2),), (None,)], "time timestamp_ntz")
    rule = q.Contract("c", (q.Rule("time <= current_timestamp()"),))
    assert q.contract_report(df, rule, now="2024-01-01 00:00:00").first().violations == 1
    assert q.contract_report(df, rule).first().violations == 0
    assert q.contract_report(df, q.Contract("none")).count() == 0


def test_schema_and_completeness(spark):
    df = spark.createDataFrame([(1, "x")], "caseid long, more string")
    got = {r.column_name: r.status for r in q.schema_conformance(df, CONTRACTS["silver.patients_demographics"]).collect()}
    assert got["caseid"] == "ok" and got["age"] == "missing" and got["more"] == "additional"
    r = q.completeness(spark.range(3), spark.range(5), F.col("id") < 4).first()
    assert (r.silver_rows, r.bronze_rows, r.completeness_pct) == (3, 4, 75.0)


def test_every_table_has_a_contract():
    assert len(CONTRACTS) == 20
    assert all(c.rules[0].kind == "no_nulls" for c in CONTRACTS.values())


def test_upsert_never_narrows(spark):
    current = spark.createDataFrame([(1, 1, 61.5, "kept"), (2, 2, 70.5, "kept"), (3, 3, 8.0, "kept")], "caseid int, subjectid int, age double, note string")
    new = spark.createDataFrame([(2, 2, 70), (3, 3, 8), (4, 4, 9)], "caseid bigint, subjectid bigint, age int")
    got = {r.caseid: (r.age, r.note) for r in up.upsert(current, new).collect()}
    assert got == {1: (61.5, "kept"), 2: (70.0, "kept"), 3: (8.0, "kept"), 4: (9.0, None)}
    log = [tuple(r) for r in up.change_log(current, new).collect()]
    assert log == [(2, 2, "age", "70.5", "70.0")]
    with pytest.raises(TypeError, match="age"):
        up.upsert(current, new.withColumn("age", F.lit("x")))


def test_lake_upsert_publishes_only_changes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = spark.createDataFrame([(1, 1, 61.5), (2, 2, 70.5)], "caseid int, subjectid int, age double")
    assert lake.upsert(first, "silver", "p") and not lake.upsert(first, "silver", "p")
    assert lake.upsert(spark.createDataFrame([(2, 2, 70)], "caseid int, subjectid int, age int"), "silver", "p")
    assert sorted(r.age for r in lake.read("silver", "p").collect()) == [61.5, 70.0]


def test_reference_check_can_split_a_hot_key(spark):
    from perispark.operators.quality import Contract, Rule, contract_report

    rows = spark.range(1000).select((F.col("id") % 7).alias("case_id"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = contract_report(rows, Contract("c", (Rule("case_id IN (SELECT DISTINCT k FROM t.x)"),)), lambda name: spark.range(5).toDF("k"))
        assert report.first().violations == sum(1 for i in range(1000) if i % 7 > 4)
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan[plan.index("SortMergeJoin"):]
    assert "hashpartitioning" in join and join.count("Exchange hashpartitioning(hash(") + join.count("Exchange hashpartitioning(cast") + join.count("Exchange hashpartitioning(case_id") + join.count("Exchange hashpartitioning(_ref") >= 2
