"""Change capture and history over full snapshots.

A snapshot is a complete copy of a table, unique on its keys. History rows
carry ``__START_AT`` and ``__END_AT`` as snapshot versions; an open row has a
NULL end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from lakeloom.operators.windows import boundary_keys

START, END = "__START_AT", "__END_AT"


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"{what} has more than one row for a key of {keys}")


def _values(keys: list[str], *frames: DataFrame) -> dict[str, DataType]:
    """All value columns of some snapshots in order of appearance, each with its newest type."""
    found: dict[str, DataType] = {}
    for df in frames:
        found |= {f.name: f.dataType for f in df.schema.fields if f.name not in keys and f.name not in (START, END)}
    return found


def _image(df: DataFrame, values: dict[str, DataType]) -> Column:
    """The value columns as a struct; a column that a snapshot lacks is NULL there."""
    return F.struct(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in values.items()])


def _paired(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two snapshots: keys, struct ``old``, struct ``new`` (NULL if absent)."""
    values = _values(keys, old, new)
    a = old.select(*keys, _image(old, values).alias("old"))
    b = new.select(*keys, _image(new, values).alias("new"))
    return a.join(b, keys, "full")


def diff_snapshots(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """keys, change (insert / update / delete) and both images; equal rows are left out.

    The images hold the columns of both snapshots. A column that was added or
    dropped counts as NULL on the other side, so its values are updates.
    """
    change = (F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "delete")
              .when(~F.col("old").eqNullSafe(F.col("new")), "update"))
    return (_paired(old, new, keys).withColumn("change", change)
            .filter(F.col("change").isNotNull()).select(*keys, "change", "old", "new"))


def change_log(old: DataFrame, new: DataFrame, keys: list[str], version: int) -> DataFrame:
    """One row per image: insert, update_preimage, update_postimage, delete."""
    def image(kind: str, side: str) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("row"))

    images = (F.when(F.col("change") == "insert", F.array(image("insert", "new")))
              .when(F.col("change") == "delete", F.array(image("delete", "old")))
              .otherwise(F.array(image("update_preimage", "old"), image("update_postimage", "new"))))
    rows = diff_snapshots(old, new, keys).select(*keys, F.explode(images).alias("i"))
    return rows.select(*keys, "i.row.*", "i._change_type", F.lit(version).alias("_version"))


def scd1(target: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Latest state after applying a complete snapshot; deletes propagate.

    What a complete snapshot holds is the state: nothing of the target is read.
    Columns keep the target's order, added ones follow, dropped ones go.
    """
    require_unique(snapshot, keys, "snapshot")
    order = [c for c in target.columns if c in snapshot.columns]
    return snapshot.select(*order, *[c for c in snapshot.columns if c not in order])


def scd2_start(snapshot: DataFrame, version: int) -> DataFrame:
    return snapshot.withColumn(START, F.lit(version)).withColumn(END, F.lit(None).cast("int"))


def scd2(history: DataFrame, snapshot: DataFrame, version: int, keys: list[str]) -> DataFrame:
    """History after the next snapshot.

    Closed rows pass through; open rows meet the snapshot in one full join that
    closes, keeps or opens, so each version costs one shuffle of the open rows.
    Columns added or dropped between versions are NULL where they are missing.
    """
    values = _values(keys, history, snapshot)
    closed = history.filter(F.col(END).isNotNull()).select(*keys, _image(history, values).alias("r"), START, END).select(*keys, "r.*", START, END)
    current = history.filter(F.col(END).isNull()).select(*keys, _image(history, values).alias("old"), F.col(START).alias("_from"))
    pairs = current.join(snapshot.select(*keys, _image(snapshot, values).alias("new")), keys, "full")
    none = F.lit(None).cast("int")
    same = F.col("old").eqNullSafe(F.col("new"))

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(F.col(side).alias("row"), start.alias(START), end.alias(END))

    ended = row("old", F.col("_from"), F.lit(version))
    opened = row("new", F.lit(version), none)
    rows = (F.when(F.col("old").isNull(), F.array(opened))
            .when(F.col("new").isNull(), F.array(ended))
            .when(same, F.array(row("old", F.col("_from"), none)))
            .otherwise(F.array(ended, opened)))
    moved = pairs.select(*keys, F.explode(rows).alias("r")).select(
        *keys, "r.row.*", f"r.{START}", f"r.{END}")
    return closed.unionByName(moved)


def scd2_from(snapshots: list[tuple[DataFrame, int]], keys: list[str]) -> DataFrame:
    """History of several snapshots at once, built as a union of versions.

    Each run of equal consecutive versions of a key becomes one row. Only the
    number of snapshots, never the data, bounds the rows of one key.
    """
    versions = [v for _, v in snapshots]
    values = _values(keys, *[df for df, _ in snapshots])
    union = reduce(DataFrame.unionByName, [
        df.select(*keys, F.lit(v).alias("_v"), _image(df, values).alias("_row")) for df, v in snapshots])
    following = dict(zip(versions, versions[1:]))
    # At most one entry per snapshot and key.
    per_key = union.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_v", "_row"))).alias("s"))
    step = F.map_from_arrays(F.array(*[F.lit(v) for v in versions]),
                             F.array(*[F.lit(following.get(v)).cast("int") for v in versions]))
    last = F.size("s") - 1

    def previous_same(i: Column) -> Column:
        prev = F.get(F.col("s"), i - 1)
        here = F.get(F.col("s"), i)
        return (i > 0) & prev["_row"].eqNullSafe(here["_row"]) & step[prev["_v"]].eqNullSafe(here["_v"])

    starts = F.filter(F.sequence(F.lit(0), last), lambda i: ~previous_same(i))
    spans = F.transform(starts, lambda i, n: F.struct(
        i.alias("a"), F.coalesce(F.get(starts, n + 1) - 1, last).alias("b")))
    runs = per_key.select(*keys, "s", F.explode(spans).alias("p"))
    return runs.select(*keys, F.get("s", F.col("p.a"))["_row"].alias("r"),
                       F.get("s", F.col("p.a"))["_v"].alias(START),
                       step[F.get("s", F.col("p.b"))["_v"]].alias(END)).select(*keys, "r.*", START, END)


class SnapshotFeed:
    """Snapshots in version order; ``next(after)`` gives the first one after a version."""

    def __init__(self, snapshots: dict[int, DataFrame]):
        self._snapshots = dict(sorted(snapshots.items()))

    def next(self, after: int | None) -> tuple[DataFrame, int] | None:
        for version, df in self._snapshots.items():
            if after is None or version > after:
                return df, version
        return None


def plant_changes(
    df: DataFrame, key: str, n_insert: int, n_update: int, n_delete: int, offset: int,
    status: str = "status", updated: str = "graduated", inserted: str = "active",
) -> DataFrame:
    """A next snapshot with known changes: inserts with shifted keys, status flips, deletes."""
    gone = boundary_keys(df, key, n_delete, last=True)
    kept = df.join(gone, key, "left_anti")
    flipped = boundary_keys(kept, key, n_update).withColumn("_flip", F.lit(True))
    new_status = F.when(F.col("_flip"), F.lit(updated)).otherwise(F.col(status))
    updates = (kept.join(flipped, key, "left").withColumn(status, new_status).select(*df.columns))
    added = (df.join(boundary_keys(df, key, n_insert), key, "left_semi")
             .withColumn(key, F.col(key) + offset).withColumn(status, F.lit(inserted)))
    return updates.unionByName(added)


def schema_diff(spark, old: StructType, new: StructType, version: int) -> DataFrame:
    """Columns added, dropped or changed in type between two versions."""
    before = {f.name: f.dataType.simpleString() for f in old.fields}
    after = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = [(version, c, "add", None, t) for c, t in after.items() if c not in before]
    rows += [(version, c, "drop", t, None) for c, t in before.items() if c not in after]
    rows += [(version, c, "retype", before[c], t) for c, t in after.items()
             if c in before and before[c] != t]
    return spark.createDataFrame(
        rows, "version int, column_name string, change string, old_type string, new_type string")
