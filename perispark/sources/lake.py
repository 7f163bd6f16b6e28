"""Bronze, silver and gold tables as Parquet folders.

``root/layer/table/v=N/b=M`` holds one batch of one version. A batch counts once its ``_PUBLISHED`` marker
exists; the newest version with a published batch is current. So a table is written once, checked as
written, and published by one small file: readers never see half a table, a failed or rejected write leaves
the old state current, and a plan may read the very table it replaces.

A keyed table is laid out in hash buckets of its keys. The marker of a version then lists where each bucket lies, so an
upsert reads and writes the buckets of its batch alone and publishes them, beside the untouched ones of earlier versions,
with the same one file. A table in parts (one per day, say) is published the same way, part by part.

The marker of a plain batch holds the least and largest values of the columns asked for, taken from the files just
written. Watermarks and ranges of such a column are answered from markers: files that cannot hold a row are not opened.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perispark.operators import upsert as up
from perispark.operators.ordering import after_watermark, dedupe_keep_last
from perispark.operators.quality import Contract, quality_gate

MARKER = "_PUBLISHED"
CHANGED = "_changed"  # in the files of an upsert: whether a row came with its batch; readers do not see it


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop

    def _children(self, path: str, prefix: str) -> list[int]:
        fs, folder = self._fs(path)
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))

    def _published(self, layer: str, table: str, version: int) -> list[str]:
        folder = f"{self.root}/{layer}/{table}/v={version}"
        batches = [f"{folder}/b={b}" for b in self._children(folder, "b=")]
        found = []
        for batch in batches:
            fs, marker = self._fs(f"{batch}/{MARKER}")
            if fs.exists(marker):
                found.append(batch)
        return found

    def current(self, layer: str, table: str) -> tuple[int, list[str]]:
        """Number and folders (batches or buckets) of the current version; ``(0, [])`` when there is none."""
        for version in reversed(self._children(f"{self.root}/{layer}/{table}", "v=")):
            batches = self._published(layer, table, version)
            if batches:
                layout = self._marker(batches[0])
                return version, [f"{self.root}/{layer}/{table}/{at}" for at in layout["at"].values()] if "at" in layout else batches
        return 0, []

    def layout(self, layer: str, table: str) -> dict | None:
        """Of a keyed table: number of ``buckets``, ``keys``, ``kinds``, ``schema``, and ``at``, the folder of each bucket.

        Of a table in parts: the ``part`` column, ``schema`` and ``at``. None for a plain table.
        """
        for version in reversed(self._children(f"{self.root}/{layer}/{table}", "v=")):
            batches = self._published(layer, table, version)
            if batches:
                found = self._marker(batches[0])
                return found if "at" in found else None
        return None

    def _marker(self, batch: str) -> dict:
        fs, marker = self._fs(f"{batch}/{MARKER}")
        if not fs.getFileStatus(marker).getLen():
            return {}
        stream = fs.open(marker)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _bounds(self, batch: str, column: str) -> tuple[str, str] | None:
        """Least and largest value of a column of a batch as text, if its marker has them; ("", "") without any value."""
        found = self._marker(batch).get("bounds", {}).get(column)
        return None if found is None else tuple(found)

    def mark(self, layer: str, table: str, column: str) -> tuple[bool, str | None]:
        """(whether the markers know it, largest value of a column as text): no data file is read."""
        _, batches = self.current(layer, table)
        bounds = [self._bounds(b, column) for b in batches]
        known = [b[1] for b in bounds if b is not None and b[1] != ""]
        if any(b is None for b in bounds):
            return False, None
        kind = self.read(layer, table).schema[column].dataType if known else None
        # the texts are compared as values of the column's type, one row per batch
        rows = self.spark.createDataFrame([(x,) for x in known], "x string") if known else None
        return True, rows.agg(F.max(F.col("x").cast(kind)).cast("string")).first()[0] if known else None

    def after(self, new: DataFrame, layer: str, table: str, column: str) -> DataFrame:
        """Rows of ``new`` past the largest stored value of a column; all of them if nothing is stored."""
        if not self.exists(layer, table):
            return new
        known, mark = self.mark(layer, table, column)
        if not known:
            return after_watermark(new, self.read(layer, table), column)
        return new if mark is None else new.where(F.col(column) > F.lit(mark).cast(new.schema[column].dataType))

    def read_range(self, layer: str, table: str, column: str, low, high) -> DataFrame:
        """Rows with ``low <= column < high``; batches whose marker rules them out are not opened."""
        _, batches = self.current(layer, table)
        whole = self.read(layer, table)
        kind = whole.schema[column].dataType
        bounds = [(i, *(self._bounds(b, column) or (None, None))) for i, b in enumerate(batches)]
        value = lambda c: F.col(c).cast(kind)
        rows = self.spark.createDataFrame(bounds, "i int, low string, high string")  # one row per batch
        wanted = rows.where(F.col("low").isNull() | (F.col("low") != "") & (value("low") < F.lit(high).cast(kind)) & (value("high") >= F.lit(low).cast(kind)))
        folders = [batches[r.i] for r in wanted.orderBy("i").collect()]
        df = self.spark.read.schema(whole.schema).parquet(*folders) if folders else whole.where("false")
        return df.where((F.col(column) >= F.lit(low).cast(kind)) & (F.col(column) < F.lit(high).cast(kind)))

    def _publish(self, batch: str, layout: dict | None = None) -> None:
        """Write the marker: under another name first, so that it appears whole."""
        fs, marker = self._fs(f"{batch}/{MARKER}")
        if layout is None:
            fs.create(marker).close()
            return
        _, draft = self._fs(f"{batch}/.{MARKER}.draft")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps(layout).encode()))
        stream.close()
        if not fs.rename(draft, marker):
            raise OSError(f"could not publish {batch}")

    def exists(self, layer: str, table: str) -> bool:
        return self.current(layer, table)[0] > 0

    def read(self, layer: str, table: str, position: bool = False) -> DataFrame:
        """The current version; ``position`` adds a unique, repeatable row order (``_file``, ``_row``)."""
        _, batches = self.current(layer, table)
        if not batches:
            raise FileNotFoundError(f"table {layer}.{table} does not exist under {self.root}")
        layout = self.layout(layer, table)
        # a keyed table names its schema: columns added later are null in older buckets, and no footer is merged
        df = self._buckets(batches, layout) if layout else self.spark.read.option("mergeSchema", len(batches) > 1).parquet(*batches).drop(CHANGED)
        if position:
            df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
        return df

    def _buckets(self, folders: Sequence[str], layout: dict) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(layout["schema"])).parquet(*folders)

    def write(self, df: DataFrame, layer: str, table: str, mode: str = "overwrite", contract: Contract | None = None,
              enforce: str = "no_nulls", skip_empty: bool = True, partition_by: Sequence[str] = (), tables=None,
              publish_if: Callable[[DataFrame], bool] = lambda written: True, bounds: Sequence[str] = ()) -> bool:
        """Write, check and publish a table; return whether it was published.

        ``bounds`` names columns whose least and largest values go into the marker.

        The contract is checked on the written files, so the plan behind ``df`` runs once; a violation raises
        and publishes nothing. An empty frame is not published, even for an overwrite, unless ``skip_empty``
        is off. ``publish_if`` is asked after the write and looks at the written rows. A table has one writer at a time.
        """
        if mode not in ("append", "overwrite"):
            raise ValueError(f"unknown mode {mode!r}")
        version, batches = self.current(layer, table)
        if mode == "overwrite" or not batches:
            version, batch = version + 1, 1
        elif self.layout(layer, table):
            raise ValueError(f"table {layer}.{table} is keyed or in parts: rows come in by upsert or write_parts")
        else:
            batch = max(int(b.rsplit("b=", 1)[1]) for b in batches) + 1
        target = f"{self.root}/{layer}/{table}/v={version}/b={batch}"
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        written = self.spark.read.schema(df.schema).parquet(target)
        if not publish_if(written) or skip_empty and written.isEmpty():
            return False
        if contract is not None:
            quality_gate(written, contract, enforce, tables or (lambda name: self.read(*name.split(".", 1))))
        # only these columns of the new files are read
        ends = [f(F.col(c)).cast("string").alias(f"{n}_{i}") for i, c in enumerate(bounds) for n, f in (("low", F.min), ("high", F.max))]
        found = written.agg(*ends).first() if bounds else {}
        self._publish(target, {"bounds": {c: [found[f"low_{i}"] or "", found[f"high_{i}"] or ""] for i, c in enumerate(bounds)}} if bounds else None)
        return True

    def write_parts(self, df: DataFrame, layer: str, table: str, part: str) -> bool:
        """Replace the parts of a table that ``df`` has rows of, by the text of column ``part``; the other parts stay.

        Parts are spread over tasks by their size. Nothing is published for an empty frame.
        """
        layout = self.layout(layer, table)
        if layout and (layout.get("part") != part or StructType.fromJson(layout["schema"]) != df.schema):
            raise ValueError(f"table {layer}.{table} is not laid out by {part} with these columns")
        version = max([0, *self._children(f"{self.root}/{layer}/{table}", "v=")]) + 1
        target = f"{self.root}/{layer}/{table}/v={version}/b=1"
        df.withColumn("_part", F.col(part).cast("string")).hint("rebalance", "_part").write.mode("overwrite").partitionBy("_part").parquet(target)
        fs, folder = self._fs(target)
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        at = (layout["at"] if layout else {}) | {n.removeprefix("_part="): f"v={version}/b=1/{n}" for n in names if n.startswith("_part=")}
        if not any(n.startswith("_part=") for n in names):
            return False
        self._publish(target, {"part": part, "schema": df.schema.jsonValue(), "at": dict(sorted(at.items()))})
        return True

    def find(self, layer: str, table: str, **key) -> DataFrame:
        """Rows with the given values. A keyed table whose keys are all given is read in one bucket, sorted by its keys."""
        layout = self.layout(layer, table)
        df = self.read(layer, table)
        if layout and "keys" in layout and set(layout["keys"]) <= set(key):
            schema = StructType.fromJson(layout["schema"])
            row = self.spark.range(1).select(*[F.lit(key[k]).cast(schema[k].dataType).alias(k) for k in layout["keys"]])
            bucket = str(row.select(up.bucket_of(schema, layout["keys"], layout["buckets"])).first()[0])
            if bucket not in layout["at"]:
                return df.where("false")
            df = self._buckets([f"{self.root}/{layer}/{table}/{layout['at'][bucket]}"], layout)
        for k, v in key.items():
            df = df.where(F.col(k).isNull() if v is None else F.col(k) == F.lit(v).cast(df.schema[k].dataType))
        return df

    def _write_buckets(self, df: DataFrame, layer: str, table: str, keys: Sequence[str], buckets: int, kept: dict[str, str],
                       publish_if: Callable[[DataFrame], bool] = lambda written: True) -> bool:
        """Write rows by bucket and publish them beside the buckets of ``kept``; each bucket is one task's file."""
        version = max([0, *self._children(f"{self.root}/{layer}/{table}", "v=")]) + 1
        target = f"{self.root}/{layer}/{table}/v={version}/b=1"
        placed = df.withColumn("_bucket", up.bucket_of(df.schema, keys, buckets))
        placed.repartition("_bucket").sortWithinPartitions("_bucket", *keys).write.mode("overwrite").partitionBy("_bucket").parquet(target)
        if not publish_if(self.spark.read.schema(df.schema).parquet(target)):
            return False
        df = df.drop(CHANGED)
        at = kept | {str(b): f"v={version}/b=1/_bucket={b}" for b in self._children(target, "_bucket=")}
        if not at:
            return False
        self._publish(target, {"buckets": buckets, "keys": list(keys), "kinds": up.key_kinds(df.schema, keys),
                               "schema": df.schema.jsonValue(), "at": dict(sorted(at.items(), key=lambda x: int(x[0])))})
        return True

    def touched(self, new: DataFrame, layer: str, table: str) -> tuple[DataFrame, list[str]] | None:
        """(rows of a keyed table in the buckets of a batch, numbers of the buckets); None if the layout does not fit the batch.

        It does not fit if a key hashes otherwise in the batch, or if a column has to be widened in the untouched files too.
        """
        layout = self.layout(layer, table)
        if layout is None or "keys" not in layout or any(k not in new.columns for k in layout["keys"]):
            return None
        schema = StructType.fromJson(layout["schema"])
        common = [c for c in new.columns if c in schema.names]
        if layout["kinds"] != up.key_kinds(new.schema, layout["keys"]) or any(
                up.common_type(c, schema[c].dataType, new.schema[c].dataType) != schema[c].dataType for c in common):
            return None
        # at most as many rows as the table has buckets
        found = [str(r[0]) for r in new.select(up.bucket_of(new.schema, layout["keys"], layout["buckets"])).distinct().collect()]
        folders = [f"{self.root}/{layer}/{table}/{layout['at'][b]}" for b in found if b in layout["at"]]
        return self._buckets(folders, layout) if folders else self.spark.createDataFrame([], schema), found

    def change_log(self, new: DataFrame, layer: str, table: str, keys: Sequence[str] = up.KEYS, ignore: Sequence[str] = up.IGNORED) -> DataFrame:
        """What a batch would change, field by field; of a keyed table only the batch's buckets are read."""
        part = self.touched(new, layer, table)
        return up.change_log(part[0] if part else self.read(layer, table), new, keys, ignore)

    def upsert(self, new: DataFrame, layer: str, table: str, keys: Sequence[str] = up.KEYS, ignore: Sequence[str] = up.IGNORED,
               order: Sequence[str] | None = None, buckets: int | None = None) -> bool:
        """Merge a batch into a table; return whether a new version was published.

        A missing table is created and an identical batch publishes nothing. ``order`` keeps the last row
        per key of the batch; without it a repeated key in the batch is an error, as is one in the table.
        ``buckets`` makes the table a keyed one (and stays as it was chosen first): pick it so that a bucket suits one
        task. A plain table becomes keyed by being rewritten once, as does a keyed one whose columns have to be widened.
        """
        if order:
            new = dedupe_keep_last(new, keys, order)
        else:
            require_unique(new, keys, "batch")
        layout = self.layout(layer, table)
        if layout and layout.get("keys") != list(keys):
            raise ValueError(f"table {layer}.{table} is keyed by {layout.get('keys')}, not by {list(keys)}")
        buckets = layout["buckets"] if layout else buckets
        if not self.exists(layer, table):
            return self._write_buckets(new, layer, table, keys, buckets, {}) if buckets else self.write(new, layer, table)
        part = self.touched(new, layer, table) if layout else None
        current = part[0] if part else self.read(layer, table)
        require_unique(current, keys, f"table {layer}.{table}")
        matched = up.match_versions(current, new, keys, ignore)
        # one join: the snapshot is written beside the table and published only if something changed in it
        snapshot = up.merged(matched, new.columns, CHANGED)
        changed = lambda written: not written.where(F.col(CHANGED)).isEmpty()
        if not buckets:
            return self.write(snapshot, layer, table, publish_if=changed)
        kept = {b: at for b, at in layout["at"].items() if b not in part[1]} if part else {}
        return self._write_buckets(snapshot, layer, table, keys, buckets, kept, publish_if=(lambda written: True) if not layout else changed)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1)
    if found:
        raise ValueError(f"{what} repeats key {found[0].asDict()}")


def cluster_for_cases(df: DataFrame, buckets: int, case: str = "case_id", time: str = "time") -> DataFrame:
    """Lay rows out by (case, day) and sort by case and time, so scans of a case skip row groups.

    The day is part of the layout key: a case with very many rows still spreads over the files.
    """
    return df.repartition(buckets, F.col(case), F.date_trunc("day", F.col(time))).sortWithinPartitions(case, time)
