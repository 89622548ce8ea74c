"""Catalog tables, target loading and versioned targets."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.cdc import require_unique, schema_diff
from lakeloom.session import durable


def write_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or replace a table, schema included."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def replace_partition(df: DataFrame, path: str, col: str) -> DataFrame:
    """Replace only the partitions present in ``df``: re-running a day is harmless."""
    even = df.hint("rebalance", col)  # few files per value, a hot value split over several tasks
    even.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_clustered(df: DataFrame, path: str, partition: str, within: list[str]) -> DataFrame:
    """Partition directories by one key and sorted row groups by the others.

    Readers prune directories on the first key and skip row groups on the next.
    The rebalance hint lets adaptive execution split a hot value over tasks of
    even size and merge small ones.
    """
    placed = df.hint("rebalance", partition)
    placed.sortWithinPartitions(partition, *within).write.mode("overwrite").partitionBy(partition).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_interleaved(df: DataFrame, path: str, keys: list[str], files: int = 64, bits: int = 4) -> DataFrame:
    """Lay a table out by several numeric or date keys at once, so that a filter on any one of them reads few files.

    Each key is scaled to 2 ** ``bits`` ranks by approximate percentiles (one
    aggregate, whose few cuts are all that reaches the driver), and the bits of
    the ranks are interleaved. Rows are range partitioned and sorted by that
    code, so every file covers a small box of all keys and its footer shows a
    narrow range for each. Rows with NULL have rank 0; rows of equal keys are
    spread by a salt where they are too many for a file.
    """
    steps = [i / 2**bits for i in range(1, 2**bits)]
    cuts = df.agg(*[F.percentile_approx(k, steps, 10_000).alias(k) for k in keys]).first()
    ranks = {k: reduce(lambda a, b: a + b, [F.when(F.col(k) >= F.lit(cut), 1).otherwise(0) for cut in cuts[k] or []], F.lit(0)) for k in keys}
    code = F.lit(0)
    for bit in reversed(range(bits)):
        for k in keys:
            code = code * 2 + F.shiftright(ranks[k], bit).bitwiseAND(1)
    placed = df.withColumn("_code", code).repartitionByRange(files, "_code", *keys, F.rand(7))
    placed.sortWithinPartitions("_code", *keys).drop("_code").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table laid out by hash of its join keys: joins of two such tables need no shuffle."""
    (df.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
     .saveAsTable(name))
    return df.sparkSession.table(name)


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: list[str], delete_when: Column | None = None,
) -> DataFrame:
    """Target after an upsert: source rows win, other rows stay.

    Matched rows whose source row satisfies ``delete_when`` are removed, and
    such rows are not inserted when unmatched (K12).
    """
    require_unique(source, keys, "merge source")
    kept = target.join(source.select(*keys), keys, "left_anti")
    incoming = source if delete_when is None else source.filter(~F.coalesce(delete_when, F.lit(False)))
    return kept.unionByName(incoming.select(*target.columns))


def delete_where(target: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def merge_partitions(path: str, source: DataFrame, keys: list[str], partition: str) -> DataFrame:
    """Upsert into a partitioned table, rewriting only the partitions that change.

    These are the ones the source names, NULL included, and the ones where its
    keys stand now: a key whose partition value changes moves. Partitions that
    lose their last row are deleted after the others are written.
    """
    spark = source.sparkSession
    table = spark.read.parquet(path).withColumn(partition, F.col(partition).cast(source.schema[partition].dataType))
    now = table.join(source.select(*keys), keys, "left_semi").select(partition)
    touched = durable(source.select(partition).union(now).distinct().withColumnRenamed(partition, "_touched"), "touched")
    target = table.join(touched, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    merged = durable(merge_upsert(target, source, keys), "merge")
    left = merged.select(partition).distinct()
    emptied = touched.join(left, F.col("_touched").eqNullSafe(F.col(partition)), "left_anti").select(F.col("_touched").cast("string")).collect()
    replace_partition(merged, path, partition)
    jvm = spark._jvm
    for (value,) in emptied:
        folder = jvm.org.apache.hadoop.fs.Path(path, jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(partition, value))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema(table.schema).parquet(path)


def copy_table(src: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Deep copy and the gate comparing rows and columns."""
    src.write.mode("overwrite").parquet(path)
    copy = src.sparkSession.read.parquet(path)
    rows = copy.agg(F.count("*")).scalar()
    gate = src.agg(F.count("*").alias("source_rows")).select(
        "source_rows", rows.alias("copy_rows"),
        F.lit(src.dtypes == copy.dtypes).alias("same_columns"))
    return copy, gate


def create_views(spark: SparkSession, views: dict[str, str]) -> None:
    """Stored SELECT texts behind reports."""
    for name, sql in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def record_metrics(spark: SparkSession, metrics: dict, path: str) -> DataFrame:
    """Append one row of run metrics."""
    spark.createDataFrame([metrics]).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _image(kind: str, row: Column) -> Column:
    return F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))


class VersionedTable:
    """Versions of a table as lists of parquet files below one path, with a log of what each version was.

    A version consists of files written for it (below ``v=<number>/<part>``)
    and files taken over by name from earlier versions, so an upsert or delete
    writes only what holds changed rows. It becomes visible when its log row is
    written, after all its files; what a failed run leaves is in no list. One
    writer at a time; readers see the last logged version.

    ``part`` names divide a version by meaning, for readers that need only some
    of it. The log, one row a version with its file names, is read on the
    driver, as Spark does with any listing of files.
    """

    LOG = ("version int, operation string, user_name string, at timestamp, row_count long, schema_json string, "
           "files array<string>, fed boolean")

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def history(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        log = hadoop.Path(f"{self.path}/_log")
        if not log.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(log):
            return self.spark.createDataFrame([], self.LOG)
        return self.spark.read.schema(self.LOG).json(f"{self.path}/_log")

    def version(self) -> int:
        last = self.history().agg(F.max("version")).first()[0]
        return -1 if last is None else last

    def _entry(self, version: int | None = None) -> Row:
        log = self.history()
        found = (log.orderBy(F.col("version").desc()) if version is None else log.filter(F.col("version") == version)).first()
        if found is None:
            raise ValueError(f"{self.path} has no version {'yet' if version is None else version}")
        return found

    def files(self, version: int | None = None) -> list[str]:
        """Names of a version's files below the path."""
        return list(self._entry(version)["files"])

    def read(self, version: int | None = None, part: str | None = None) -> DataFrame:
        entry = self._entry(version)
        return self._scan([f for f in entry["files"] if part is None or f.split("/")[1] == part], entry)

    def _scan(self, names: list[str], entry: Row) -> DataFrame:
        schema = StructType.fromJson(json.loads(entry["schema_json"]))
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{n}" for n in names])

    def commit(self, df: DataFrame | dict[str, DataFrame], operation: str, version: int | None = None, keep: list[str] | None = None,
               kept_rows: int = 0, changes: DataFrame | None = None) -> int:
        """A further version of the rows of ``df`` (or of each part) and the files ``keep``, which hold ``kept_rows`` rows.

        ``changes`` are the images of the rows that change, for ``changes``;
        without them the version counts as a replacement of all rows.
        """
        parts = df if isinstance(df, dict) else {"rows": df}
        number = self.version() + 1 if version is None else version
        if number <= self.version():
            return self.version()  # applied before: replays are harmless
        names, rows = list(keep or []), kept_rows
        for part, own in parts.items():
            seen = Observation()  # rows are counted while they are written
            folder = f"v={number}/{part}"
            own.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{self.path}/{folder}")
            rows += seen.get["rows"]
            names += [f"{folder}/{name}" for name in self._part_files(folder)]
        if changes is not None:
            changes.write.mode("overwrite").parquet(f"{self.path}/_changes/v={number}")
        schema = next(iter(parts.values())).schema
        entry = [(number, operation, self.spark.sparkContext.sparkUser(), dt.datetime.now(dt.timezone.utc), rows, schema.json(), names, changes is not None)]
        self.spark.createDataFrame(entry, self.LOG).coalesce(1).write.mode("append").json(f"{self.path}/_log")
        return number

    def _part_files(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return sorted(n for n in (f.getPath().getName() for f in found) if not n.startswith(("_", ".")))

    def _holding(self, entry: Row, rows: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Names of the files that hold any of the rows; ``rows`` must keep the column ``__file``."""
        if not entry["files"]:
            return []
        marked = self._scan(entry["files"], entry).withColumn("__file", F.col("_metadata.file_path"))
        name = F.regexp_extract("__file", r"(v=\d+/[^/]+/[^/]+)$", 1)
        return [r[0] for r in rows(marked).select(name.alias("f")).distinct().collect()]

    def merge(self, source: DataFrame, keys: list[str], delete_when: Column | None = None) -> int:
        """Upsert that rewrites only files holding a key of the source (K10); rows as ``merge_upsert`` gives them.

        One scan of the keys finds the files, whose rows then meet the source in
        one join; new rows and change images both come from its staged result.
        The source should be small beside the table and its keys unique.
        """
        entry = self._entry()
        incoming = durable(source, "incoming")
        require_unique(incoming, keys, "merge source")
        hit = self._holding(entry, lambda t: t.join(incoming.select(*keys), keys, "left_semi"))
        old = self._scan(hit, entry)
        columns = old.columns
        gone = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
        new = incoming.select(*keys, F.struct(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in columns]).alias("__new"), gone.alias("__gone"))
        pairs = durable(old.select(*keys, F.struct(*columns).alias("__old")).join(new, keys, "full"), "pairs")
        old_row, new_row = F.col("__old"), F.col("__new")
        inserted, matched = old_row.isNull() & ~F.col("__gone"), old_row.isNotNull() & new_row.isNotNull()
        row = F.when(new_row.isNull(), old_row).when(~F.col("__gone"), new_row)
        merged = pairs.withColumn("__row", row).filter("__row IS NOT NULL").select("__row.*")
        images = (F.when(inserted, F.array(_image("insert", new_row)))
                  .when(matched & F.col("__gone"), F.array(_image("delete", old_row)))
                  .when(matched & ~old_row.eqNullSafe(new_row), F.array(_image("update_preimage", old_row), _image("update_postimage", new_row))))
        changes = pairs.select(F.explode(images).alias("i")).select("i.row.*", "i._change_type")
        taken = pairs.filter(old_row.isNotNull()).count()
        return self.commit(merged, "MERGE", keep=[f for f in entry["files"] if f not in set(hit)], kept_rows=entry["row_count"] - taken, changes=changes)

    def delete(self, predicate: Column) -> int:
        """Remove rows for which the predicate is true, rewriting only the files that hold one."""
        entry = self._entry()
        hit = self._holding(entry, lambda t: t.filter(predicate))
        rows = self._scan(hit, entry)
        return self.commit(delete_where(rows, predicate), "DELETE", keep=[f for f in entry["files"] if f not in set(hit)],
                           kept_rows=entry["row_count"] - rows.count(), changes=rows.filter(predicate).withColumn("_change_type", F.lit("delete")))

    def changes(self, first: int, last: int | None = None) -> DataFrame:
        """Change images of the versions from ``first`` to ``last``, as written at their commits.

        Columns of the table, ``_change_type`` (insert, update_preimage,
        update_postimage, delete) and ``_version``. Versions are not compared: a
        replacement counts as a delete of every row before and an insert of
        every row after it.
        """
        log = {r["version"]: r for r in self.history().collect()}
        numbers = [v for v in sorted(log) if first <= v <= (max(log) if last is None else last)]
        found = []
        for number in numbers:
            entry = log[number]
            if entry["fed"]:
                schema = StructType.fromJson(json.loads(entry["schema_json"])).add("_change_type", "string")
                images = [self.spark.read.schema(schema).parquet(f"{self.path}/_changes/v={number}")]
            else:
                before = [log[v] for v in sorted(log) if v < number][-1:]
                images = [self._scan(e["files"], e).withColumn("_change_type", F.lit(kind))
                          for e, kind in [*((b, "delete") for b in before), (entry, "insert")]]
            found += [i.withColumn("_version", F.lit(number)) for i in images]
        if not found:
            raise ValueError(f"{self.path} has no version from {first} to {last}")
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)

    def schema_history(self) -> DataFrame:
        """Column changes from version to version with who and when."""
        rows = self.history().select("version", "user_name", "at", "schema_json").orderBy("version").collect()
        steps = [schema_diff(self.spark, StructType.fromJson(json.loads(a["schema_json"])),
                             StructType.fromJson(json.loads(b["schema_json"])), b["version"])
                 .withColumn("user_name", F.lit(b["user_name"])).withColumn("at", F.lit(b["at"]))
                 for a, b in zip(rows, rows[1:])]
        out = schema_diff(self.spark, StructType(), StructType(), 0).withColumn(
            "user_name", F.lit("")).withColumn("at", F.lit(None).cast("timestamp"))
        for step in steps:
            out = out.unionByName(step)
        return out
