"""Data contracts: rules about a table, compiled to one aggregation, and the gate in front of every write."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perispark.functions.columns import nan_to_null
from perispark.operators.ordering import exact_quantiles

NO_NULLS = re.compile(r"^\s*no_nulls\s*\((.*)\)\s*$")
UNIQUE = re.compile(r"^\s*(?:is_unique|uniqueness)\s*\((.*?)\)\s*(?:==\s*100\s*%?)?\s*$")
REFERENCE = re.compile(r"^\s*(\w+)\s+IN\s*\(\s*SELECT\s+(?:DISTINCT\s+)?(\w+)\s+FROM\s+([\w.]+)\s*\)\s*$", re.I)
INFORMATIVE = "schema_allows_additional_columns"


class ContractViolation(ValueError):
    """A gated table broke its contract."""


@dataclass(frozen=True)
class Rule:
    text: str
    severity: str = "error"

    @property
    def kind(self) -> str:
        if NO_NULLS.match(self.text):
            return "no_nulls"
        if UNIQUE.match(self.text):
            return "unique"
        if REFERENCE.match(self.text):
            return "reference"
        return "info" if self.text.strip() == INFORMATIVE else "predicate"

    def columns(self) -> list[str]:
        match = NO_NULLS.match(self.text) or UNIQUE.match(self.text)
        return [c.strip() for c in match.group(1).split(",") if c.strip()] if match else []


LAG = re.compile(r"^\s*P(\d+(?:\.\d+)?)\s*(<=|<)\s*(\d+(?:\.\d+)?)\s*(ms|s|m|h|d)\b(.*)$", re.I | re.S)
SHARE = re.compile(r"^\s*(>=|>)?\s*(\d+(?:\.\d+)?)\s*%(.*)$", re.S)
SECONDS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400}


@dataclass(frozen=True)
class Objective:
    """A service-level objective: a quantile of a lag in seconds, or a share in percent; neither if the text only informs."""

    name: str
    text: str

    @property
    def rank(self) -> float | None:
        """Quantile of the lag, between 0 and 1."""
        match = LAG.match(self.text)
        return float(match.group(1)) / 100 if match else None

    @property
    def limit(self) -> float | None:
        """Most seconds of a lag, or least percent of a share."""
        match = LAG.match(self.text)
        if match:
            return float(match.group(3)) * SECONDS[match.group(4).lower()]
        match = SHARE.match(self.text)
        return float(match.group(2)) if match else None

    def met(self, measured: Column) -> Column:
        match = LAG.match(self.text) or SHARE.match(self.text)
        if match is None:
            return F.lit(None).cast("boolean")
        sign = match.group(2) if LAG.match(self.text) else match.group(1)
        limit = F.lit(self.limit)
        # a share without a sign ("100% of ...") is a least share
        return {"<=": measured <= limit, "<": measured < limit, ">": measured > limit}.get(sign or ">=", measured >= limit)


@dataclass(frozen=True)
class Contract:
    id: str
    rules: tuple[Rule, ...] = ()
    fields: tuple[tuple[str, str, bool], ...] = field(default=())
    objectives: tuple[Objective, ...] = ()

    @classmethod
    def from_dict(cls, doc: Mapping) -> "Contract":
        """Accepts ``schema`` as a list of fields or as ``{fields: [...]}``."""
        schema = doc.get("schema") or []
        if isinstance(schema, Mapping):
            schema = schema.get("fields") or []
        quality = doc.get("quality") or {}
        constraints = quality.get("constraints") or []
        targets = quality.get("slo") or doc.get("slo") or {}
        return cls(
            id=(doc.get("contract") or {}).get("id", "Unknown"),
            rules=tuple(Rule(str(c.get("rule", "")), c.get("severity", "error")) for c in constraints if c.get("rule")),
            fields=tuple((f["name"], f.get("type", "string"), bool(f.get("nullable", True))) for f in schema),
            objectives=tuple(Objective(str(name), str(text)) for name, text in targets.items()),
        )

    @classmethod
    def load(cls, path: str) -> "Contract":
        """From a YAML or JSON file; YAML needs PyYAML."""
        with open(path, encoding="utf-8") as handle:
            if path.endswith(".json"):
                return cls.from_dict(json.load(handle))
            try:
                import yaml
            except ImportError as err:  # pragma: no cover
                raise ImportError("reading YAML contracts needs PyYAML; JSON works without") from err
            return cls.from_dict(yaml.safe_load(handle))


def _missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    col = F.col(f"`{name}`")
    return (nan_to_null(col) if kind in ("double", "float") else col).isNull()


def contract_report(df: DataFrame, contract: Contract, tables: Callable[[str], DataFrame] | None = None,
                    now: str | None = None, enforce: str = "all") -> DataFrame:
    """(contract_id, rule, column_name, severity, violations, message) for every rule, lazily.

    Null and predicate rules share one aggregation over one scan. Uniqueness and reference rules need a
    shuffle each and run only under ``enforce="all"``. A null predicate counts as satisfied.
    """
    checks: list[tuple[Rule, str | None, Column, str]] = []
    frames: list[DataFrame] = []
    for rule in contract.rules:
        if rule.kind == "no_nulls":
            for name in rule.columns():
                if name in df.columns:
                    checks.append((rule, name, F.count_if(_missing(df, name)), "null values"))
                else:
                    checks.append((rule, name, F.lit(1).cast("long"), "column does not exist"))
        elif enforce != "all" or rule.kind == "info":
            continue
        elif rule.kind == "predicate":
            text = rule.text if now is None else re.sub(r"current_timestamp\(\)", f"timestamp_ntz '{now}'", rule.text, flags=re.I)
            checks.append((rule, None, F.count_if(~F.coalesce(F.expr(text), F.lit(True))), "rows break the rule"))
        elif rule.kind == "unique":
            names = rule.columns()
            doubles = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            frames.append(_report_row(doubles, contract, rule, ", ".join(names), "repeated keys"))
        else:
            own, other, table = REFERENCE.match(rule.text).groups()
            if tables is None:
                raise ValueError(f"rule {rule.text!r} needs the tables argument")
            known = tables(table).select(F.col(other).alias("_ref")).distinct()
            # the hash in the condition gives both sides plain shuffles, so that AQE can split a hot key
            same = (F.col(own) == F.col("_ref")) & (F.hash(F.col(own).cast("string")) == F.hash(F.col("_ref").cast("string")))
            orphans = df.where(F.col(own).isNotNull()).join(known, same, "left_anti")
            frames.append(_report_row(orphans, contract, rule, own, "rows without a match"))
    if checks:
        counted = df.agg(*[expr.alias(f"c{i}") for i, (_, _, expr, _) in enumerate(checks)])
        rows = [
            F.struct(
                F.lit(contract.id).alias("contract_id"), F.lit(rule.text).alias("rule"),
                F.lit(name).cast("string").alias("column_name"), F.lit(rule.severity).alias("severity"),
                F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("violations"), F.lit(text).alias("message"),
            )
            for i, (rule, name, _, text) in enumerate(checks)
        ]
        frames.insert(0, counted.select(F.inline(F.array(*rows))))
    if not frames:
        return df.sparkSession.createDataFrame([], "contract_id string, rule string, column_name string, severity string, violations long, message string")
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    return report


def _report_row(bad: DataFrame, contract: Contract, rule: Rule, name: str, text: str) -> DataFrame:
    return bad.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(contract.id).alias("contract_id"), F.lit(rule.text).alias("rule"), F.lit(name).alias("column_name"),
        F.lit(rule.severity).alias("severity"), "violations", F.lit(text).alias("message"),
    )


def quality_gate(df: DataFrame, contract: Contract, enforce: str = "no_nulls",
                 tables: Callable[[str], DataFrame] | None = None, now: str | None = None) -> DataFrame:
    """Return ``df``, or raise :class:`ContractViolation` when a rule is broken.

    ``no_nulls`` checks only those rules, whatever their severity; ``all`` checks every rule and lets
    warnings and infos pass.
    """
    if enforce not in ("no_nulls", "all"):
        raise ValueError(f"unknown enforce {enforce!r}")
    # one row per rule of the contract
    rows = contract_report(df, contract, tables, now, enforce).where("violations > 0").collect()
    fatal = [r for r in rows if enforce == "no_nulls" or r.severity == "error"]
    if fatal:
        lines = [f"{r.rule}: {r.column_name or 'row'}: {r.violations} {r.message}" for r in fatal]
        raise ContractViolation(f"contract {contract.id} is broken:\n" + "\n".join(lines))
    return df


# contract vocabulary to the Spark types that satisfy it
ACCEPTED = {
    "string": {"string", "long", "integer"},
    "timestamp": {"timestamp", "timestamp_ntz", "date"},
    "float": {"double", "float", "long", "integer"},
    "number": {"double", "float", "long", "integer", "decimal"},
    "integer": {"long", "integer", "short", "byte"},
    "boolean": {"boolean"},
}


def schema_conformance(df: DataFrame, contract: Contract) -> DataFrame:
    """(column_name, expected, actual, status) for every contract field and every additional column."""
    actual = {f.name: f.dataType.typeName() for f in df.schema.fields}
    rows = []
    for name, kind, _ in contract.fields:
        found = actual.get(name)
        status = "missing" if found is None else "ok" if found in ACCEPTED.get(kind, {kind}) else "type"
        rows.append((name, kind, found, status))
    known = {f[0] for f in contract.fields}
    rows += [(name, None, kind, "additional") for name, kind in actual.items() if name not in known]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, actual string, status string")


def completeness(silver: DataFrame, bronze: DataFrame, valid: Column | None = None) -> DataFrame:
    """Rows of silver against (valid) rows of bronze, in percent."""
    base = bronze if valid is None else bronze.where(F.coalesce(valid, F.lit(False)))
    total = base.agg(F.count(F.lit(1))).scalar()
    counted = silver.agg(F.count(F.lit(1)).alias("silver_rows")).withColumn("bronze_rows", total)
    return counted.withColumn("completeness_pct", F.try_divide(F.col("silver_rows") * 100.0, "bronze_rows"))


SLO_SCHEMA = "contract_id string, objective string, expected string, limit double, measured double, met boolean"


def measured_lags(rows: DataFrame, event: str, arrived: str, ranks: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of the seconds between an event and its arrival: ``by``, rank, lag_seconds and the rows that count."""
    micros = F.unix_micros(F.col(arrived).cast("timestamp")) - F.unix_micros(F.col(event).cast("timestamp"))
    lags = rows.select(*by, (micros / F.lit(1e6)).alias("lag_seconds"))
    return exact_quantiles(lags, "lag_seconds", ranks, by).withColumnRenamed("value", "lag_seconds")


def slo_report(contract: Contract, lags: DataFrame | None = None, shares: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per objective of a contract: what is expected, what was measured, and whether it is met.

    ``lags`` holds ``lag_seconds`` of single rows, for objectives like "P95 <= 10m"; ``shares`` maps names such as
    ``completeness`` and ``accuracy`` to one-row tables with ``completeness_pct``. An objective without a measurement, or
    whose text only informs, has nulls.
    """
    spark, report = SparkSession.active(), None
    for o in contract.objectives:
        if o.rank is not None and lags is not None:
            found = exact_quantiles(lags, "lag_seconds", [o.rank]).agg(F.max("value").alias("measured"))
        elif o.rank is None and o.limit is not None and shares and o.name in shares:
            found = shares[o.name].agg(F.max("completeness_pct").alias("measured"))
        else:
            found = spark.range(1).select(F.lit(None).cast("double").alias("measured"))
        row = found.select(F.lit(contract.id).alias("contract_id"), F.lit(o.name).alias("objective"), F.lit(o.text).alias("expected"),
                           F.lit(o.limit).cast("double").alias("limit"), F.col("measured").cast("double").alias("measured"), o.met(F.col("measured")).alias("met"))
        report = row if report is None else report.unionByName(row)
    return spark.createDataFrame([], SLO_SCHEMA) if report is None else report


FILTER_BITS, BITMAP_BITS = 23, 32_768  # bits of a key filter (1 MB); bits of one row of bitmap_construct_agg


def key_filter(batch: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """A one-hash Bloom filter of a batch's keys: ``block``, ``bitmap``; 2 ** ``bits`` bits at most, whatever the batch."""
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    return batch.select(F.floor(place / BITMAP_BITS).cast("int").alias("block"), (place % BITMAP_BITS).alias("bit")).groupBy("block").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"))


def may_match(stored: DataFrame, keys: Sequence[str], found: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows of a stored table whose keys the filter holds: all that match the batch, and few others while the batch is small.

    The filter is at most 2 ** ``bits`` / 32,768 rows of 4 KB and is broadcast, so the stored rows are not shuffled for it.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    rows = stored.select(*keys).withColumn("_block", F.floor(place / BITMAP_BITS).cast("int")).withColumn("_bit", (place % BITMAP_BITS).cast("int"))
    met = rows.join(F.broadcast(found.withColumnRenamed("block", "_block")), "_block")
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.where(F.call_function("shiftright", byte, F.col("_bit") % 8).bitwiseAND(F.lit(1)) == 1).select(*keys)


def append_report(batch: DataFrame, stored: DataFrame, contract: Contract, tables: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The key rules of a contract for a batch about to be appended to a stored table, in the form of :func:`contract_report`.

    A unique key must occur once in the batch and not in the table; a reference must be in its table or, where a table
    refers to itself, in the batch. Stored keys pass the batch's filter before the exact join, so a small batch does not
    reshuffle a large table.
    """
    report = None
    for rule in contract.rules:
        if rule.kind == "unique":
            names = rule.columns()
            own = batch.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
            known = _present(own, may_match(_cast_like(stored, batch, names), names, key_filter(batch, names)), names)
            row = _report_row(known.where("n > 1 OR present"), contract, rule, ", ".join(names), "repeated keys")
        elif rule.kind == "reference":
            own, other, table = REFERENCE.match(rule.text).groups()
            if tables is None:
                raise ValueError(f"rule {rule.text!r} needs the tables argument")
            refs = batch.where(F.col(own).isNotNull()).groupBy(F.col(own).alias("_ref")).agg(F.count(F.lit(1)).alias("n"))
            there = tables(table).select(F.col(other).cast(batch.schema[own].dataType).alias("_ref"))
            known = _present(refs, may_match(there, ["_ref"], key_filter(refs, ["_ref"])), ["_ref"])
            bad = known.where("NOT present").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            row = bad.select(F.lit(contract.id).alias("contract_id"), F.lit(rule.text).alias("rule"), F.lit(own).alias("column_name"),
                             F.lit(rule.severity).alias("severity"), "violations", F.lit("rows without a match").alias("message"))
        else:
            continue
        report = row if report is None else report.unionByName(row)
    if report is None:
        return batch.sparkSession.createDataFrame([], "contract_id string, rule string, column_name string, severity string, violations long, message string")
    return report


def _cast_like(stored: DataFrame, batch: DataFrame, names: Sequence[str]) -> DataFrame:
    return stored.select(*[F.col(n).cast(batch.schema[n].dataType).alias(n) for n in names])


def _present(keys: DataFrame, stored: DataFrame, names: Sequence[str]) -> DataFrame:
    """``keys`` (with ``n``) and whether each is among the stored ones; null keys match each other."""
    marks = keys.select(*names, "n", F.lit(False).alias("present")).unionByName(stored.distinct().select(*names, F.lit(0).cast("long").alias("n"), F.lit(True).alias("present")))
    return marks.groupBy(*names).agg(F.sum("n").alias("n"), F.max("present").alias("present")).where("n > 0")
