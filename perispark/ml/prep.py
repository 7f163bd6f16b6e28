"""Feature preparation: checks, imputation, scaling and ordinal codes, fitted once and applied as expressions and joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perispark import fixed_values as fv
from perispark.functions.columns import lenient_double, normalize_columns
from perispark.operators.ordering import running_totals
from perispark.session import use_checkpoint_dir


def load_matrix(df: DataFrame, target: str = "result") -> DataFrame:
    """All-numeric table with an integer target; empty tables, a missing target, nulls or no features are errors."""
    df = normalize_columns(df, "snake")
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found in {df.columns}")
    if len(df.columns) < 2:
        raise ValueError("the table has no feature columns")
    matrix = df.select(*[lenient_double(df, c).alias(c) for c in df.columns])
    checks = matrix.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in matrix.columns]).first()
    if checks["_rows"] == 0:
        raise ValueError("the table is empty")
    bad = {c: checks[c] for c in matrix.columns if checks[c]}
    if bad:
        raise ValueError(f"null values after conversion to numbers: {bad}")
    return matrix.withColumn(target, F.col(target).cast("int"))


def pick_target(df: DataFrame, candidates: Sequence[str] = tuple(fv.TARGET_CANDIDATES)) -> tuple[DataFrame, str]:
    """(normalised table, target): the first candidate present, else the last column; the target comes last."""
    df = normalize_columns(df, "snake")
    target = next((c for c in candidates if c in df.columns), df.columns[-1])
    features = [c for c in df.columns if c != target]
    if not features:
        raise ValueError("the table has no feature columns")
    return df.select(*features, target), target


def active_features(df: DataFrame, columns: Sequence[str], target: str) -> tuple[DataFrame, list[str]]:
    """Rows with a known target, and those of ``columns`` with any value at all (one aggregation)."""
    known = df.where(F.col(target).isNotNull())
    present = [c for c in columns if c in df.columns]
    if not present:
        return known, []
    counts = known.agg(*[F.count(c).alias(c) for c in present]).first()
    return known, [c for c in present if counts[c]]


def _values(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """How often each value of each column occurs: feature, value, n."""
    cells = df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], list(columns), "feature", "value")
    return cells.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_median(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians of columns that have any value, by one path for all sizes and columns.

    Values are counted, ordered in ranges within each column and cumulated; the median is where the count passes half.
    """
    if not columns:
        return {}
    ranked = running_totals(_values(df, columns, "double"), "value", ["n"], by=["feature"])
    totals = ranked.groupBy("feature").agg(F.sum("n").alias("total"))
    low = F.min(F.when(F.col("cum_n") >= F.floor((F.col("total") + 1) / 2), F.col("value")))
    high = F.min(F.when(F.col("cum_n") >= F.floor(F.col("total") / 2) + 1, F.col("value")))
    # one row per column
    rows = ranked.join(totals, "feature").groupBy("feature").agg(((low + high) / 2).alias("m")).collect()
    return {r["feature"]: r["m"] for r in rows}


def _number(x: float) -> str:
    return f"{float(x)!r}D" if x == x and abs(x) != float("inf") else f"double('{x}')"


LISTED_VALUES = 256  # categories of a feature that are looked up in a constant list; more are joined


@dataclass
class Preprocessor:
    """Fitted values: medians, means and deviations of numbers; modes of categories, and their codes as a table.

    A feature without any value when fitted has no median or mode; it becomes the constant 0, or -1 for a category.
    """

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]
    modes: dict[str, str]
    codes: DataFrame | None  # feature, value, code: as many rows as there are categories
    listed: dict[str, list[str]] = field(default_factory=dict)  # sorted values of features with at most LISTED_VALUES
    mode_codes: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [f"f_{c}" for c in (*self.numeric, *self.categorical)]

    @property
    def joined(self) -> list[str]:
        """Categories that are looked up by a join."""
        return [c for c in self.categorical if c in self.modes and c not in self.listed]

    def _number(self, c: str) -> Column:
        if c not in self.medians:
            return F.lit(0.0)
        return F.expr(f"(coalesce(`{c}`, {_number(self.medians[c])}) - {_number(self.means[c])}) / {_number(self.stds[c] or 1.0)}")

    def _category(self, c: str, codes: Column | None = None) -> Column:
        """The code of a category: its place in the sorted values, or what a join has found."""
        if c not in self.modes:
            return F.lit(-1.0)
        if c in self.listed:
            filled = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c]))
            return (F.array_position(F.array(*[F.lit(v) for v in self.listed[c]]), filled) - 1).cast("double")
        return F.when(F.col(f"`{c}`").isNull(), F.lit(self.mode_codes[c])).otherwise(F.coalesce(codes, F.lit(-1.0)))

    def transform(self, df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
        """``df`` with a column ``f_<name>`` per feature; a category that was not seen when fitted gets -1.

        Features with few values need no join. The others are joined to their codes: all in one look-up if ``key`` names
        columns that together are unique and not null, else one after the other.
        """
        out, codes = df, {c: F.col(f"_code_{c}") for c in self.joined}
        if codes and key:
            out = look_up(df, self.joined, self.codes.withColumnRenamed("code", "found"), key, "_code_")
        else:
            for c in self.joined:
                known = self.codes.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias(f"_code_{c}"))
                out = out.join(known, F.col(f"`{c}`").cast("string") == F.col("_value"), "left").drop("_value")
        return out.select(*[F.col(f"`{c}`") for c in df.columns], *[self._number(c).alias(f"f_{c}") for c in self.numeric],
                          *[self._category(c, codes.get(c)).alias(f"f_{c}") for c in self.categorical])

    def vector(self, place: int) -> Column:
        """All features as an array, for rows that :func:`look_up` has given the codes of several fits; ``place`` is this fit's."""
        return F.array(*[self._number(c) for c in self.numeric],
                       *[self._category(c, F.col(f"_codes_{c}")[place] if c in self.joined else None) for c in self.categorical])

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(c, "numeric", self.medians.get(c), self.means.get(c), self.stds.get(c), None, None, None) for c in self.numeric]
        rows += [(c, "categorical", None, None, None, self.modes.get(c), self.mode_codes.get(c), self.listed.get(c)) for c in self.categorical]
        spark.createDataFrame(rows, FITTED_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/fitted")
        codes = self.codes if self.codes is not None else spark.createDataFrame([], CODES_SCHEMA)
        codes.write.mode("overwrite").parquet(f"{path}/codes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        rows = spark.read.parquet(f"{path}/fitted").collect()  # one row per feature
        numbers, cats = [[r for r in rows if r.kind == kind] for kind in ("numeric", "categorical")]
        return cls([r.feature for r in numbers], [r.feature for r in cats],
                   *[{r.feature: r[name] for r in numbers if r.median is not None} for name in ("median", "mean", "std")],
                   {r.feature: r.mode for r in cats if r.mode is not None}, spark.read.parquet(f"{path}/codes"),
                   {r.feature: list(r["values"]) for r in cats if r["values"] is not None},
                   {r.feature: r.mode_code for r in cats if r.mode_code is not None})


FITTED_SCHEMA = "feature string, kind string, median double, mean double, std double, mode string, mode_code double, values array<string>"
CODES_SCHEMA = "feature string, value string, code double"


def look_up(df: DataFrame, columns: Sequence[str], dictionary: DataFrame, key: Sequence[str], prefix: str) -> DataFrame:
    """``df`` with what a dictionary (feature, value, found) holds for each of ``columns``, as ``<prefix><column>``.

    All columns are looked up in one join: cells are laid out as rows, meet the dictionary, and are gathered again with
    the row they came from. Without a match the result is null. ``key`` has to be unique and not null.
    """
    kind = dictionary.schema["found"].dataType
    cells = df.select(*key, F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns])))
    met = cells.join(dictionary, ["feature", "value"]).select(*key, F.lit(None).cast(T.StructType(df.schema.fields)).alias("_all"), "feature", "found")
    whole = df.select(*key, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_all"), F.lit(None).cast("string").alias("feature"), F.lit(None).cast(kind).alias("found"))
    found = [F.first(F.when(F.col("feature") == c, F.col("found")), ignorenulls=True).alias(f"{prefix}{c}") for c in columns]
    return whole.unionByName(met).groupBy(*key).agg(F.first("_all", ignorenulls=True).alias("_all"), *found).select("_all.*", *[f"{prefix}{c}" for c in columns])


def fold_values(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int, fold: str) -> DataFrame:
    """Distinct values in order: feature, number or text, and per fit how often each occurs in its training rows.

    Fit ``i`` below ``k`` trains on all folds but ``i``, fit ``k`` on all rows. Counts per fold add up, so one shuffle
    serves all fits: ``m<i>`` is the count over all rows less that of fold ``i``, ``p<i>`` is 1 where that is above 0. Both
    come with running totals (``cum_...``) within the feature. The feature "" counts the rows themselves.
    """
    none = {"number": F.lit(None).cast("double"), "text": F.lit(None).cast("string")}
    cells = [{"feature": F.lit(""), **none, "number": F.lit(0.0)}]
    cells += [{"feature": F.lit(c), **none, "number": F.col(f"`{c}`").cast("double")} for c in numeric]
    cells += [{"feature": F.lit(c), **none, "text": F.col(f"`{c}`").cast("string")} for c in categorical]
    laid = df.select(F.col(fold) if k else F.lit(0).alias(fold), F.inline(F.array(*[F.struct(*[v.alias(n) for n, v in c.items()]) for c in cells])))
    counted = laid.where("number IS NOT NULL OR text IS NOT NULL").groupBy("feature", "number", "text").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(fold) == i).alias(f"n{i}") for i in range(k)])
    counts = {f"m{i}": F.col("n") - F.col(f"n{i}") for i in range(k)} | {f"m{k}": F.col("n")}
    marks = {f"p{i}": F.when(m > 0, 1).otherwise(0).cast("long") for i, m in enumerate(counts.values())}
    values = counted.select("feature", F.struct("number", "text").alias("value"), *[v.alias(n) for n, v in (counts | marks).items()])
    use_checkpoint_dir(df.sparkSession)
    return running_totals(values, "value", [*counts, *marks], by=["feature"]).select("feature", "value.*", *[f"{c}{x}" for c in ("", "cum_") for x in [*counts, *marks]]).checkpoint()


def fit_folds(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], k: int, fold: str = "fold") -> tuple[list[Preprocessor], DataFrame]:
    """(the preparation fitted without each of ``k`` folds, and last the one on all rows; codes of all fits side by side).

    Numbers are imputed by their median and standardised; categories are imputed by the most frequent (ties: the smallest)
    and coded by their sorted order, however many there are. The driver holds a few values per feature and fit.
    """
    values, fits = fold_values(df, numeric, categorical, k, fold), range(k + 1)
    totals = values.groupBy("feature").agg(*[F.sum(f"m{i}").alias(f"total{i}") for i in fits])
    stats = []
    for i in fits:
        seen, total = F.col(f"cum_m{i}"), F.col(f"total{i}")
        low = F.min(F.when(seen >= F.floor((total + 1) / 2), F.col("number")))
        high = F.min(F.when(seen >= F.floor(total / 2) + 1, F.col("number")))
        mode = F.min_by(F.struct("text", F.col(f"cum_p{i}") - 1), F.struct(-F.col(f"m{i}"), F.col("text")))
        stats.append(F.struct(F.max(total).alias("total"), ((low + high) / 2).alias("median"), F.sum(F.col("number") * F.col(f"m{i}")).alias("sum"),
                              F.when(F.max(f"m{i}") > 0, mode).alias("mode")).alias(f"s{i}"))
    # one row per feature
    rows = {r.feature: r for r in values.join(totals, "feature").groupBy("feature").agg(F.sum(F.lit(1)).alias("distinct"), *stats).collect()}
    n = [rows[""][f"s{i}"].total if "" in rows else 0 for i in fits]
    fitted = []
    for i in fits:
        known = {c: rows[c][f"s{i}"] for c in (*numeric, *categorical) if c in rows and rows[c][f"s{i}"].total > 0}
        medians = {c: known[c].median for c in numeric if c in known}
        means = {c: (known[c]["sum"] + (n[i] - known[c].total) * m) / n[i] for c, m in medians.items()}
        modes = {c: known[c].mode for c in categorical if c in known}
        fitted.append(Preprocessor(list(numeric), list(categorical), medians, means, {}, {c: m[0] for c, m in modes.items()}, None, {}, {c: float(m[1]) for c, m in modes.items()}))
    spread = []
    for i, p in enumerate(fitted):
        if p.medians:
            mean = F.create_map(*[F.lit(x) for pair in p.means.items() for x in pair])[F.col("feature")]
            spread.append(F.sum(F.pow(F.col("number") - mean, 2) * F.col(f"m{i}")).alias(f"s{i}"))
    small = [c for c in categorical if c in rows and rows[c].distinct <= LISTED_VALUES]
    texts = F.array_sort(F.collect_list(F.when(F.col("feature").isin(*small) if small else F.lit(False), F.struct("text", *[F.col(f"p{i}") > 0 for i in fits]))))
    # one row per feature; the values of a feature only if they are at most LISTED_VALUES
    for r in values.where("feature <> ''").groupBy("feature").agg(texts.alias("texts"), *spread).collect():
        for i, p in enumerate(fitted):
            if r.feature in p.medians:
                missing = n[i] - rows[r.feature][f"s{i}"].total
                p.stds[r.feature] = ((r[f"s{i}"] + missing * (p.medians[r.feature] - p.means[r.feature]) ** 2) / n[i]) ** 0.5
            if r.feature in small and r.feature in p.modes:
                p.listed[r.feature] = [t[0] for t in r.texts if t[1 + i]]
    coded = values.where(F.col("feature").isin(*categorical) if categorical else F.lit(False))
    code = [F.when(F.col(f"p{i}") > 0, (F.col(f"cum_p{i}") - 1).cast("double")) for i in fits]
    for i, p in enumerate(fitted):
        p.codes = coded.where(F.col(f"p{i}") > 0).select("feature", F.col("text").alias("value"), code[i].alias("code")) if categorical else None
    return fitted, coded.select("feature", F.col("text").alias("value"), F.array(*code).alias("found"))


def fit_preprocessor(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Preprocessor:
    """The preparation fitted on all rows (see :func:`fit_folds`)."""
    return fit_folds(df, numeric, categorical, 0)[0][0]


def apply_preprocessor(df: DataFrame, fitted: Preprocessor, key: Sequence[str] = ()) -> DataFrame:
    return fitted.transform(df, key)
