"""Sources, sinks, upserts and contracts, each with the SQL that says the same."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import functions as F

from perispark import fixed_values as fv
from perispark.contracts import CONTRACTS
from perispark.operators import quality as q
from perispark.operators import upsert as up
from perispark.operators.ordering import after_watermark
from perispark.operators.ordering import sample_n as take_sample
from perispark.ml.prep import load_matrix
from perispark.ml.prep import pick_target as choose_target
from perispark.queries import fixtures as fx
from perispark.queries.cleaning import DEMOGRAPHICS_SQL, LAB_VALID, LABS_RESULTS_SQL, labs, patients
from perispark.queries.registry import Registry, rounded, with_double_id
from perispark.session import use_checkpoint_dir
from perispark.sources.csv import read_csv_feed, read_or_fallback, with_audit
from perispark.sources.lake import Lake

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles


def shared_folder(spark, name):
    """A new folder where every executor can write."""
    return f"{use_checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


# ---- sources and sinks ----
@query("SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM {orders}")
def ingest_roundtrip(spark, sf):
    folder = shared_folder(spark, "feed")
    feed = fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", F.lit(None).cast("string").alias("note"))
    feed.write.option("header", True).csv(folder)
    return read_csv_feed(spark, folder, "o_orderkey long, o_totalprice double, o_orderpriority string, note string")


@query("""SELECT c_custkey, c_name, 'Clinical_EHR' AS source_system, TIMESTAMP '2024-05-01 12:30:00' AS ingest_time FROM {customer}""")
def audit_columns(spark, sf):
    return with_audit(fx.table(spark, sf, "customer").select("c_custkey", "c_name"), fv.SOURCE_PATIENTS, dt.datetime(2024, 5, 1, 12, 30))


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_totalprice >= 100000
 UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_totalprice < 50000""")
def sink_roundtrip(spark, sf):
    """Write, replace, then append."""
    rows = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lake = Lake(spark, shared_folder(spark, "lake"))
    lake.write(rows, "silver", "orders")
    lake.write(lake.read("silver", "orders").where("o_totalprice >= 100000"), "silver", "orders")
    lake.write(rows.where("o_totalprice < 50000"), "silver", "orders", mode="append")
    lake.write(rows.where("o_totalprice < 0"), "silver", "orders")  # empty: skipped
    return lake.read("silver", "orders")


@query("SELECT event_id, ts, value FROM {events}")
def read_fallback(spark, sf):
    """A missing table is replaced by its CSV copy, whose time column becomes ``ts``."""
    folder = shared_folder(spark, "fallback")
    fx.table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("time"), "value").write.option("header", True).csv(folder)
    lake = Lake(spark, shared_folder(spark, "lake"))
    read = read_or_fallback(spark, lambda: lake.read("silver", "vitals_clean"), folder)
    return read.withColumn("event_id", F.col("event_id").cast("long"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM {lineitem}
 ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42')), l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100""")
def sample_n(spark, sf):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return take_sample(fx.table(spark, sf, "lineitem").select(*keys, "l_quantity"), keys, 100, 42)


@query("""SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderdate > (SELECT max(o_orderdate) FROM {orders} WHERE o_orderdate < DATE '1996-01-01')""")
def incremental_load(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return after_watermark(orders, orders.where("o_orderdate < DATE '1996-01-01'"), "o_orderdate")


@query("""SELECT l_quantity AS quantity, l_extendedprice AS extended_price, l_discount AS discount,
 CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS result FROM {lineitem}""")
def ml_matrix(spark, sf):
    raw = fx.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_quantity AS STRING) AS ` Quantity`", "CAST(l_extendedprice AS STRING) AS `Extended Price`", "l_discount AS Discount",
        "CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS Result")
    return load_matrix(raw)


@query("SELECT l_quantity AS quantity, l_tax AS tax, l_returnflag AS class FROM {lineitem}")
def pick_target(spark, sf):
    raw = fx.table(spark, sf, "lineitem").selectExpr("l_returnflag AS Class", "l_quantity AS Quantity", "l_tax AS ` Tax`")
    return choose_target(raw)[0]


@query("SELECT event_id, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS ts, value FROM {events}")
def read_fallback_epoch(spark, sf):
    """A fallback file whose time column holds seconds since 1970."""
    folder = shared_folder(spark, "fallback")
    events = fx.table(spark, sf, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("time"), "value")
    events.write.option("header", True).csv(folder)
    lake = Lake(spark, shared_folder(spark, "lake"))
    return read_or_fallback(spark, lambda: lake.read("silver", "vitals_clean"), folder).withColumn("event_id", F.col("event_id").cast("long"))


# ---- upsert ----
MATCH_SQL = f"""SELECT c.caseid AS ck, n.caseid AS nk, c.age AS ca, n.age AS na, c.sex AS cs, n.sex AS ns, c.dx AS cd, n.dx AS nd,
 c.source_system AS csrc, n.source_system AS nsrc, c.subjectid AS csub, n.subjectid AS nsub,
 c.caseid IS NOT NULL AND n.caseid IS NOT NULL AND (c.age IS DISTINCT FROM n.age OR c.sex IS DISTINCT FROM n.sex OR c.dx IS DISTINCT FROM n.dx) AS upd
 FROM ({fx.CURRENT_SQL}) c FULL JOIN ({fx.INCOMING_SQL}) n ON c.caseid = n.caseid AND c.subjectid = n.subjectid"""


def versions(spark, sf):
    return fx.project(spark, sf, fx.CURRENT_SQL), fx.project(spark, sf, fx.INCOMING_SQL)


@query(f"""SELECT CASE WHEN upd OR ck IS NULL THEN nk ELSE ck END AS caseid, CASE WHEN upd OR ck IS NULL THEN nsub ELSE csub END AS subjectid,
 CASE WHEN upd OR ck IS NULL THEN na ELSE ca END AS age, CASE WHEN upd OR ck IS NULL THEN ns ELSE cs END AS sex,
 CASE WHEN upd OR ck IS NULL THEN nd ELSE cd END AS dx, CASE WHEN upd OR ck IS NULL THEN nsrc ELSE csrc END AS source_system FROM ({MATCH_SQL})""")
def upsert_snapshot(spark, sf):
    return up.upsert(*versions(spark, sf))


@query(f"""SELECT nk AS caseid, nsub AS subjectid, 'age' AS column_name, CAST(ca AS VARCHAR) AS old_value, CAST(na AS VARCHAR) AS new_value
 FROM ({MATCH_SQL}) WHERE upd AND ca IS DISTINCT FROM na UNION ALL
 SELECT nk, nsub, 'sex', cs, ns FROM ({MATCH_SQL}) WHERE upd AND cs IS DISTINCT FROM ns""")
def upsert_change_log(spark, sf):
    return up.change_log(*versions(spark, sf))


WIDE_BATCH_SQL = """SELECT c_custkey AS caseid, c_custkey + 100000 AS subjectid, CAST(floor(c_acctbal) AS BIGINT) AS age FROM {customer} WHERE c_custkey % 2 = 0"""


@query(f"""SELECT coalesce(c.caseid, n.caseid) AS caseid, coalesce(c.subjectid, n.subjectid) AS subjectid,
 CASE WHEN n.caseid IS NULL THEN c.age ELSE CAST(n.age AS DOUBLE) END AS age, c.sex, c.dx, c.source_system
 FROM ({fx.CURRENT_SQL}) c FULL JOIN ({WIDE_BATCH_SQL}) n ON c.caseid = n.caseid AND c.subjectid = n.subjectid""")
def upsert_widening(spark, sf):
    """A batch of whole ages and fewer columns against a table of fractional ages: kept rows stay as they are."""
    return up.upsert(fx.project(spark, sf, fx.CURRENT_SQL), fx.project(spark, sf, WIDE_BATCH_SQL))


# ---- contracts ----
def report(frame, *rules, enforce="all", name="check", **more):
    contract = q.Contract(name, tuple(q.Rule(*r) if isinstance(r, tuple) else q.Rule(r) for r in rules))
    return q.contract_report(frame, contract, enforce=enforce, **more)


def row_sql(rule, column, severity, count, message, name="check"):
    shown = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"SELECT '{name}' AS contract_id, '{rule}' AS rule, {shown} AS column_name, '{severity}' AS severity, ({count}) AS violations, '{message}' AS message"


def nulls_of(source, column):
    return f"SELECT count(*) FROM ({source}) WHERE {column} IS NULL"


@query(" UNION ALL ".join([
    row_sql("no_nulls(caseid, dt, result, unit)", c, "error", nulls_of(fx.LABS_RAW_SQL, c), "null values") for c in ("caseid", "dt", "result")
] + [row_sql("no_nulls(caseid, dt, result, unit)", "unit", "error", "SELECT CAST(1 AS BIGINT)", "column does not exist")]))
def dq_no_nulls(spark, sf):
    return report(fx.labs_raw(spark, sf), "no_nulls(caseid, dt, result, unit)", enforce="no_nulls")


@query(row_sql("is_unique(caseid)", "caseid", "error", f"SELECT count(*) FROM (SELECT caseid FROM ({fx.PATIENTS_RAW_SQL}) GROUP BY caseid HAVING count(*) > 1)", "repeated keys")
       + " UNION ALL " + row_sql("uniqueness(subjectid) == 100%", "subjectid", "error",
                                 f"SELECT count(*) FROM (SELECT subjectid FROM ({fx.PATIENTS_RAW_SQL}) GROUP BY subjectid HAVING count(*) > 1)", "repeated keys"))
def dq_unique(spark, sf):
    return report(fx.project(spark, sf, fx.PATIENTS_RAW_SQL), "is_unique(caseid)", "uniqueness(subjectid) == 100%")


PREDICATES = ["age BETWEEN 0 AND 120", "height BETWEEN 40 AND 250 OR height IS NULL", "weight >= 2 AND weight <= 400", "age < bmi", "icu_days IN (0, 1, 2)"]


@query(" UNION ALL ".join(
    row_sql(p, None, "error", f"SELECT count(*) FROM ({fx.PATIENTS_RAW_SQL}) WHERE NOT coalesce({p}, TRUE)", "rows break the rule") for p in PREDICATES))
def dq_predicates(spark, sf):
    return report(fx.project(spark, sf, fx.PATIENTS_RAW_SQL), *PREDICATES)


@query(row_sql("time <= current_timestamp()", None, "error",
               f"SELECT count(*) FROM ({fx.VITALS_RAW_SQL}) WHERE time > TIMESTAMP '2000-06-01 00:00:00'", "rows break the rule"))
def dq_not_future(spark, sf):
    return report(fx.project(spark, sf, fx.VITALS_RAW_SQL), "time <= current_timestamp()", now="2000-06-01 00:00:00")


REFERENCE_RULE = "case_id IN (SELECT DISTINCT c_custkey FROM bronze.customer)"


@query(row_sql(REFERENCE_RULE, "case_id", "warning",
               f"SELECT count(*) FROM ({fx.VITALS_RAW_SQL}) WHERE case_id NOT IN (SELECT c_custkey FROM {{customer}})", "rows without a match"))
def dq_referential(spark, sf):
    return report(fx.project(spark, sf, fx.VITALS_RAW_SQL), (REFERENCE_RULE, "warning"), tables=lambda name: fx.table(spark, sf, name.split(".")[1]))


@query(" UNION ALL ".join([
    row_sql("no_nulls(caseid, name, result, surgery_phase)", c, "error", nulls_of(LABS_RESULTS_SQL, c), "null values", "silver.labs_results_classified")
    for c in ("caseid", "name", "result", "surgery_phase")
] + [row_sql("result >= 0", None, "error", f"SELECT count(*) FROM ({LABS_RESULTS_SQL}) WHERE result < 0", "rows break the rule", "silver.labs_results_classified")]))
def dq_report(spark, sf):
    return q.contract_report(labs(spark, sf)[0], CONTRACTS["silver.labs_results_classified"])


@query(" UNION ALL ".join(
    [row_sql("no_nulls(caseid, age)", c, "error", nulls_of(DEMOGRAPHICS_SQL, c), "null values", "silver.patients_demographics") for c in ("caseid", "age")]
    + [row_sql("is_unique(caseid)", "caseid", "error", f"SELECT count(*) - count(DISTINCT caseid) FROM ({DEMOGRAPHICS_SQL})", "repeated keys", "silver.patients_demographics")]
    + [row_sql(p, None, "error", f"SELECT count(*) FROM ({DEMOGRAPHICS_SQL}) WHERE NOT coalesce({p}, TRUE)", "rows break the rule", "silver.patients_demographics")
       for p in ("age BETWEEN 0 AND 120", "height BETWEEN 40 AND 250 OR height IS NULL", "weight BETWEEN 2 AND 400 OR weight IS NULL")]))
def dq_gate(spark, sf):
    """The gate lets the cleaned table through; the report is what it looked at."""
    contract = CONTRACTS["silver.patients_demographics"]
    return q.contract_report(q.quality_gate(patients(spark, sf)[0], contract, enforce="all"), contract)


SCHEMA = [("caseid", "string", "long", "ok"), ("name", "string", "string", "ok"), ("result", "float", "double", "ok"), ("surgery_phase", "string", "string", "ok"),
          ("is_most_recent", "boolean", "boolean", "ok"), ("dt", None, "double", "additional"), ("tie", None, "long", "additional")]


@query(f"WITH l AS ({LABS_RESULTS_SQL}) " + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, {repr(kind) if kind else 'CAST(NULL AS VARCHAR)'} AS expected, '{actual}' AS actual, '{status}' AS status, "
    f"(SELECT count({name}) FROM l) AS present" for name, kind, actual, status in SCHEMA))
def dq_schema(spark, sf):
    """Conformance of every column, with how many values it holds."""
    table = labs(spark, sf)[0]
    held = table.agg(*[F.count(c).alias(c) for c in table.columns]).unpivot([], table.columns, "column_name", "present")
    return q.schema_conformance(table, CONTRACTS["silver.labs_results_classified"]).join(held, "column_name")


@query(f"""SELECT (SELECT count(*) FROM ({LABS_RESULTS_SQL})) AS silver_rows, (SELECT count(*) FROM ({fx.LABS_RAW_SQL}) WHERE {LAB_VALID}) AS bronze_rows,
 100.0 * (SELECT count(*) FROM ({LABS_RESULTS_SQL})) / (SELECT count(*) FROM ({fx.LABS_RAW_SQL}) WHERE {LAB_VALID}) AS completeness_pct""")
def dq_completeness(spark, sf):
    valid = F.col("caseid").isNotNull() & F.col("dt").isNotNull() & (F.col("result") >= 0)
    return q.completeness(labs(spark, sf)[0], fx.labs_raw(spark, sf), valid)


@query(f"""SELECT (SELECT count(*) FROM ({LABS_RESULTS_SQL})) AS silver_rows, (SELECT count(*) FROM ({fx.LABS_RAW_SQL})) AS bronze_rows,
 round(100.0 * (SELECT count(*) FROM ({LABS_RESULTS_SQL})) / (SELECT count(*) FROM ({fx.LABS_RAW_SQL})), 6) AS completeness_pct""")
def dq_accuracy(spark, sf):
    """Share of all events that pass the rules."""
    return rounded(q.completeness(labs(spark, sf)[0], fx.labs_raw(spark, sf)), "completeness_pct")


LAGS_SQL = """SELECT 'silver.vitals_clean' AS of, ts AS event, ts + INTERVAL 1 SECOND * ((event_id * 7919) % 900) AS arrived FROM {events} WHERE event_id % 53 <> 0
 UNION ALL SELECT 'silver.labs_results_classified', o_orderdate, CASE WHEN o_orderkey % 61 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 SECOND * ((o_orderkey * 31) % 800) END FROM {orders}"""
LAG_SECONDS = "epoch_us(arrived) / 1e6 - epoch_us(event) / 1e6"
RANKS = [0.0, 0.5, 0.95, 0.99, 1.0]


def lag_rows(spark, sf):
    """Events and results with the time they came in."""
    return fx.project(spark, sf, re.sub(r"INTERVAL 1 SECOND \* \((.*?\) % \d+)\)", r"make_dt_interval(0, 0, 0, \1)", LAGS_SQL))


@query(" UNION ALL ".join(f"SELECT of, CAST({r} AS DOUBLE) AS rank, round(quantile_cont({LAG_SECONDS}, {r}), 4) AS lag_seconds, count({LAG_SECONDS}) AS n FROM ({LAGS_SQL}) GROUP BY of"
                          for r in RANKS))
def lag_quantiles(spark, sf):
    return rounded(q.measured_lags(lag_rows(spark, sf), "event", "arrived", RANKS, ["of"]), "lag_seconds", digits=4)


FRESH = ["silver.vitals_clean", "silver.labs_results_classified"]


@query(" UNION ALL ".join(f"""SELECT '{c}' AS contract_id, 'freshness' AS objective, '{o.text}' AS expected, CAST({o.limit} AS DOUBLE) AS "limit", round(v, 4) AS measured, v <= {o.limit} AS met
 FROM (SELECT quantile_cont({LAG_SECONDS}, {o.rank}) AS v FROM ({LAGS_SQL}) WHERE of = '{c}')""" for c in FRESH for o in CONTRACTS[c].objectives if o.name == "freshness"))
def slo_freshness(spark, sf):
    """The lag of each table at its objective's quantile, against the limit."""
    found, rows = None, lag_rows(spark, sf).withColumn("lag_seconds", (F.unix_micros(F.col("arrived").cast("timestamp")) - F.unix_micros(F.col("event").cast("timestamp"))) / F.lit(1e6))
    for c in FRESH:
        one = q.slo_report(CONTRACTS[c], rows.where(F.col("of") == c)).where("objective = 'freshness'")
        found = one if found is None else found.unionByName(one)
    return rounded(found, "measured", digits=4)


def share_sql(contract, name, share):
    o = next(o for o in CONTRACTS[contract].objectives if o.name == name)
    return f"""SELECT '{contract}' AS contract_id, '{name}' AS objective, '{o.text}' AS expected, CAST({o.limit} AS DOUBLE) AS "limit", round(v, 6) AS measured, v >= {o.limit} AS met FROM (SELECT {share} AS v)"""


LAB_ROWS, RAW_ROWS = f"(SELECT count(*) FROM ({LABS_RESULTS_SQL}))", f"(SELECT count(*) FROM ({fx.LABS_RAW_SQL})"


@query(" UNION ALL ".join([
    share_sql("silver.labs_results_classified", "completeness", f"100.0 * {LAB_ROWS} / {RAW_ROWS} WHERE {LAB_VALID})"),
    share_sql("silver.labs_quarantine", "completeness", f"100.0 * ({RAW_ROWS}) - {LAB_ROWS}) / {RAW_ROWS} WHERE NOT coalesce({LAB_VALID}, FALSE))"),
]))
def slo_completeness(spark, sf):
    """Valid rows that reached the clean table, and invalid rows that were captured in quarantine, against their objectives."""
    raw, (results, rejected) = fx.labs_raw(spark, sf), labs(spark, sf)[:2]
    valid = F.coalesce(F.col("caseid").isNotNull() & F.col("dt").isNotNull() & (F.col("result") >= 0), F.lit(False))
    shares = {"silver.labs_results_classified": q.completeness(results, raw, valid), "silver.labs_quarantine": q.completeness(rejected, raw, ~valid)}
    found = None
    for name, share in shares.items():
        one = q.slo_report(CONTRACTS[name], shares={"completeness": share}).where("objective = 'completeness'")
        found = one if found is None else found.unionByName(one)
    return rounded(found, "measured")


@query(f"""SELECT CASE WHEN upd OR ck IS NULL THEN nk ELSE ck END AS caseid, CASE WHEN upd OR ck IS NULL THEN nsub ELSE csub END AS subjectid,
 CASE WHEN upd OR ck IS NULL THEN na ELSE ca END AS age, CASE WHEN upd OR ck IS NULL THEN ns ELSE cs END AS sex,
 CASE WHEN upd OR ck IS NULL THEN nd ELSE cd END AS dx, CASE WHEN upd OR ck IS NULL THEN nsrc ELSE csrc END AS source_system FROM ({MATCH_SQL})""")
def upsert_buckets(spark, sf):
    """The same snapshot from a table laid out in buckets of its keys: the batch comes in two parts, then once more as a whole."""
    current, batch = versions(spark, sf)
    lake = Lake(spark, shared_folder(spark, "keyed"))
    lake.upsert(current, "bronze", "patients", buckets=16)
    lake.upsert(batch.where("caseid % 20 = 0"), "bronze", "patients")
    lake.upsert(batch.where("caseid % 20 <> 0"), "bronze", "patients")
    lake.upsert(batch.withColumn("source_system", F.lit("again")), "bronze", "patients")  # changes nothing
    return lake.read("bronze", "patients")


@query("""SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderdate > (SELECT max(o_orderdate) FROM {orders} WHERE o_orderdate < DATE '1996-01-01')""")
def incremental_marker(spark, sf):
    """The same rows as ``incremental_load``; the mark comes from the stored table's markers, its files are not read."""
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    lake = Lake(spark, shared_folder(spark, "marked"))
    for part in ("o_orderdate < DATE '1994-01-01'", "o_orderdate >= DATE '1994-01-01' AND o_orderdate < DATE '1996-01-01'"):
        lake.write(orders.where(part), "bronze", "orders", mode="append", bounds=["o_orderdate"])
    return lake.after(orders, "bronze", "orders", "o_orderdate")


APPEND_RULES = ["is_unique(o_orderkey)", "o_custkey IN (SELECT c_custkey FROM bronze.customer)"]
BATCH_SQL = "SELECT * FROM {orders} WHERE o_orderkey % 7 = 0 OR o_orderkey % 35 = 1 UNION ALL SELECT * FROM {orders} WHERE o_orderkey % 49 = 0"
STORED_SQL = "SELECT * FROM {orders} WHERE o_orderkey % 7 <> 0"
KNOWN_SQL = "SELECT * FROM {customer} WHERE c_custkey % 11 <> 0"


@query(" UNION ALL ".join([
    row_sql(APPEND_RULES[0], "o_orderkey", "error", f"""SELECT count(*) FROM (SELECT o_orderkey, count(*) AS n FROM ({BATCH_SQL}) GROUP BY o_orderkey) b
 WHERE n > 1 OR o_orderkey IN (SELECT o_orderkey FROM ({STORED_SQL}))""", "repeated keys"),
    row_sql(APPEND_RULES[1], "o_custkey", "error", f"SELECT count(*) FROM ({BATCH_SQL}) WHERE o_custkey NOT IN (SELECT c_custkey FROM ({KNOWN_SQL}))", "rows without a match"),
]))
def dq_append_keys(spark, sf):
    """The key rules for a batch about to be appended: stored keys pass the batch's filter before the exact comparison."""
    batch, stored, known = (fx.project(spark, sf, sql) for sql in (BATCH_SQL, STORED_SQL, KNOWN_SQL))
    return q.append_report(batch, stored, q.Contract("check", tuple(q.Rule(r) for r in APPEND_RULES)), lambda name: known)


@query("""SELECT * FROM {customer} WHERE c_custkey = (SELECT max(c_custkey) FROM {customer})""")
def keyed_lookup(spark, sf):
    """One row of a table in buckets of its key: one bucket is read, and the key reaches its scan."""
    rows = fx.table(spark, sf, "customer")
    lake = Lake(spark, shared_folder(spark, "found"))
    lake.upsert(rows, "silver", "customer", ["c_custkey"], buckets=16)
    return lake.find("silver", "customer", c_custkey=rows.agg(F.max("c_custkey")).first()[0])
