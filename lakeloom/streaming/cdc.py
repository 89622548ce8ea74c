"""Snapshot changes kept up by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.cdc import END, START, scd1, scd2, scd2_start
from lakeloom.session import drop, durable
from lakeloom.sinks.tables import VersionedTable


def apply_snapshot(table: VersionedTable, snapshot: DataFrame, version: int, keys: list[str], kind: int) -> int:
    """Fold one snapshot into a type 1 or type 2 target; an applied version is skipped.

    A type 2 target lies in two parts, ``open`` and ``closed``. Only open rows
    are read and written again; rows that end are appended to the closed part,
    whose earlier files every version takes over by name, so the work follows
    the current state and not the length of the history. Change images are
    written with the version.
    """
    done = table.version()
    if version <= done:
        return done
    if kind == 1:
        return table.commit(snapshot if done < 0 else scd1(table.read(), snapshot, keys), "SCD1", version)
    if done < 0:
        started = scd2_start(snapshot, version)
        return table.commit({"open": started, "closed": started.limit(0)}, "SCD2", version)
    current = table.read(part="open")
    moved = durable(scd2(current, snapshot, version, keys), "moved")
    closed_files = [f for f in table.files() if f.split("/")[1] == "closed"]
    ended, opened = F.col(END) == version, F.col(START) == version
    if moved.columns != current.columns:  # columns came or went: closed rows show NULL, their files stay
        moved = moved.select(*current.columns, *[c for c in moved.columns if c not in current.columns])
    before = moved.filter(ended).withColumn(END, F.lit(None).cast("int")).withColumn("_change_type", F.lit("update_preimage"))
    changes = (before.unionByName(moved.filter(ended).withColumn("_change_type", F.lit("update_postimage")))
               .unionByName(moved.filter(opened).withColumn("_change_type", F.lit("insert"))))
    kept_rows = table.read(part="closed").count()
    return table.commit({"open": moved.filter(F.col(END).isNull()), "closed": moved.filter(ended)}, "SCD2", version,
                        keep=closed_files, kept_rows=kept_rows, changes=changes)


COMPLETE = "version int, row_count long"


def stream_snapshots(
    spark: SparkSession, path: str, schema, checkpoint: str, target: str, keys: list[str], kind: int = 2,
    version: str = "snapshot_version", complete: str | None = None,
) -> VersionedTable:
    """Read snapshot files tagged with a version and maintain the target.

    A snapshot may arrive in any number of drops. Rows are staged per micro
    batch, so a replayed batch replaces itself, and a version is folded in only
    when the JSON rows (version, row_count) below ``complete`` (default: the
    folder ``_complete`` of ``path``) announce it and that many rows are there.
    Versions are folded in order; a version that is not whole holds back later
    ones, one with more rows than announced is an error. Staged rows lie apart
    by version: a run reads only what waits, and deletes what is applied.
    """
    table = VersionedTable(spark, target)
    staged, markers = f"{target}/_staged", complete or f"{path}/_complete"

    def stage(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy(version).parquet(f"{staged}/batch-{epoch}")

    query = (spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(stage)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if not _found(spark, markers):
        return table
    own_schema = StructType([f for f in schema.fields if f.name != version])
    for number, expected in sorted(spark.read.schema(COMPLETE).json(markers).distinct().collect()):  # one row per snapshot
        folders = _found(spark, f"{staged}/batch-*/{version}={number}")
        if number > table.version():
            own = spark.read.schema(own_schema).parquet(*folders) if folders else spark.createDataFrame([], own_schema)
            arrived = own.count()
            if arrived > expected:
                raise ValueError(f"snapshot {number} was announced with {expected} rows, {arrived} have arrived")
            if arrived < expected:
                break
            apply_snapshot(table, own, number, keys, kind)
        drop(spark, folders)  # applied now or before
    return table


def _found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [str(f.getPath()) for f in found or ()]


def announce(spark: SparkSession, path: str, version: int, row_count: int) -> None:
    """Declare a snapshot complete once ``row_count`` rows of it have arrived below ``path``."""
    spark.createDataFrame([(version, row_count)], COMPLETE).coalesce(1).write.mode("append").json(f"{path}/_complete")
