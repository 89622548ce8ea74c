"""Versions as file lists: only files with changed rows are rewritten, change images come with the commit."""

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cdc
from lakeloom.sinks.tables import VersionedTable, delete_where, merge_upsert
from lakeloom.streaming.cdc import apply_snapshot

SHAPE = "id long, grp long, v string"


def seeded(spark, path, files):
    """10,000 rows in files that each hold a range of ids."""
    target = VersionedTable(spark, str(path))
    rows = spark.range(10_000).select("id", (F.col("id") % 7).alias("grp"), F.concat(F.lit("v"), F.col("id")).alias("v"))
    target.commit(rows.repartitionByRange(files, "id"), "SEED")
    return target


@pytest.fixture
def table(spark, tmp_path):
    return seeded(spark, tmp_path / "t", 20)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_rewrites_files_with_matches_only(spark, tmp_path):
    table = seeded(spark, tmp_path / "wide", 200)
    before, files = table.read().collect(), table.files()
    assert len(files) >= 100
    source = spark.range(100).select((F.col("id") + 4000).alias("id"), F.lit(0).cast("long").alias("grp"), F.lit("new").alias("v"))
    source = source.unionByName(spark.createDataFrame([(50_000, 1, "added"), (None, 2, "no key")], SHAPE))
    want = rows_of(merge_upsert(spark.createDataFrame(before, SHAPE), source, ["id"]))
    assert table.merge(source, ["id"]) == 1
    after = table.files()
    taken = set(files) & set(after)
    assert len(files) - len(taken) <= 5 and all(f.startswith("v=1/") for f in set(after) - taken)
    assert rows_of(table.read()) == want and rows_of(table.read(0)) == sorted(map(tuple, before), key=repr)
    assert table.history().filter("version = 1").first()["row_count"] == len(want) == 10_002


def test_merge_with_delete_and_delete(spark, table):
    source = spark.createDataFrame([(10, 3, "gone"), (11, 4, "v11"), (9_999, 5, "kept"), (70_000, 6, "gone")], SHAPE)
    want = rows_of(merge_upsert(table.read(), source, ["id"], F.col("v") == "gone"))
    table.merge(source, ["id"], F.col("v") == "gone")
    assert rows_of(table.read()) == want
    kinds = {(r.id, r._change_type) for r in table.changes(1, 1).collect()}
    assert kinds == {(10, "delete"), (9_999, "update_preimage"), (9_999, "update_postimage")}
    files = table.files()
    rest = rows_of(delete_where(table.read(), F.col("id").between(200, 210)))
    table.delete(F.col("id").between(200, 210))
    assert rows_of(table.read()) == rest and len(set(files) - set(table.files())) <= 3
    assert table.history().filter("version = 2").first()["row_count"] == len(rest)
    assert {(r.id, r._change_type, r._version) for r in table.changes(2).collect()} == {(i, "delete", 2) for i in range(200, 211)}


def test_nothing_to_do_keeps_every_file(spark, table):
    files = set(table.files())
    table.delete(F.col("id") < 0)
    table.merge(spark.createDataFrame([], SHAPE), ["id"])
    assert files <= set(table.files()) and table.read().count() == 10_000
    assert table.changes(1, 2).isEmpty()


def test_failed_merge_leaves_the_old_state(spark, table):
    before = rows_of(table.read())
    broken = spark.range(3).select("id", F.lit(1).cast("long").alias("grp"), F.when(F.col("id") < 2, "x").otherwise(F.raise_error(F.lit("broken"))).alias("v"))
    with pytest.raises(Exception, match="broken"):
        table.merge(broken, ["id"])
    with pytest.raises(ValueError, match="more than one row"):
        table.merge(spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], SHAPE), ["id"])
    with pytest.raises(Exception, match="broken"):  # fails while files of the new version are written
        table.commit(broken, "REPLACE")
    assert table.version() == 0 and rows_of(table.read()) == before
    assert table.merge(spark.createDataFrame([(1, 1, "ok")], SHAPE), ["id"]) == 1 and table.read().count() == 10_000


def test_empty_and_missing_tables(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "e"))
    with pytest.raises(ValueError, match="no version"):
        target.read()
    target.commit(spark.createDataFrame([], SHAPE), "SEED")
    target.merge(spark.createDataFrame([(1, None, None)], SHAPE), ["id"])
    assert rows_of(target.read()) == [(1, None, None)]
    target.delete(F.lit(True))
    assert target.read().isEmpty() and target.history().orderBy("version").collect()[-1]["row_count"] == 0


def test_feed_equals_the_diff(spark, table):
    """Random merges and deletes: images of every commit are those of a comparison of the two versions."""
    import random

    rng = random.Random(8)
    for _ in range(3):
        rows = [(i, rng.randrange(2), rng.choice(["a", None, "gone"])) for i in rng.sample(range(9_900, 10_100), 30)]
        number = table.merge(spark.createDataFrame(rows, SHAPE), ["id"], F.col("v") == "gone")
        want = cdc.change_log(table.read(number - 1), table.read(number), ["id"], number)
        assert rows_of(table.changes(number, number).select(want.columns)) == rows_of(want)
    table.delete(F.col("grp") == 1)
    want = cdc.change_log(table.read(3), table.read(4), ["id"], 4)
    assert rows_of(table.changes(4).select(want.columns)) == rows_of(want)
    assert table.changes(1).count() == sum(table.changes(v, v).count() for v in (1, 2, 3, 4))
    plan = table.changes(1, 4)._jdf.queryExecution().toString()
    assert "Join" not in plan and "_changes/v=1" in "".join(table.changes(1, 1).inputFiles())


def test_replacements_in_the_feed(spark, tmp_path):
    target = VersionedTable(spark, str(tmp_path / "r"))
    target.commit(spark.createDataFrame([(1, 1, "a")], SHAPE), "SEED")
    target.commit(spark.createDataFrame([(2, 9)], "id long, extra int"), "REPLACE")
    got = sorted(((r.id, r.v, r.extra, r._change_type, r._version) for r in target.changes(0).collect()), key=repr)
    assert got == [(1, "a", None, "delete", 1), (1, "a", None, "insert", 0), (2, None, 9, "insert", 1)]
    with pytest.raises(ValueError, match="no version"):
        target.changes(5)


def test_history_parts(spark, tmp_path):
    """A snapshot leaves all closed files as they are; the state is that of the plain fold; replays change nothing."""
    import random

    rng = random.Random(9)
    target, history = VersionedTable(spark, str(tmp_path / "h")), None
    for version in range(1, 6):
        snap = spark.createDataFrame([(i, rng.randrange(2), rng.choice(["a", "b"])) for i in range(40) if rng.random() < 0.8], SHAPE)
        if version == 4:
            snap = snap.withColumn("extra", F.lit(4))
        before = {f for f in target.files() if "/closed/" in f} if version > 1 else set()
        assert apply_snapshot(target, snap, version, ["id"], 2) == version
        history = cdc.scd2_start(snap, 1) if version == 1 else spark.createDataFrame(
            (made := cdc.scd2(history, snap, version, ["id"])).collect(), made.schema)
        columns = history.columns
        assert rows_of(target.read().select(columns)) == rows_of(history)
        assert before <= set(target.files()) and not any(f.startswith(f"v={version}/") for f in before)
        assert target.read(part="open").filter(F.col(cdc.END).isNotNull()).isEmpty()
        assert target.read(part="closed").filter(F.col(cdc.END).isNull()).isEmpty()
        assert target.history().filter(F.col("version") == version).first()["row_count"] == target.read().count()
    files = target.files()
    assert apply_snapshot(target, snap, 3, ["id"], 2) == 5 and target.files() == files
    feed = target.changes(5, 5)
    assert feed.filter("_change_type = 'insert'").count() == target.read().filter(F.col(cdc.START) == 5).count()
    assert feed.filter("_change_type = 'update_postimage'").count() == target.read().filter(F.col(cdc.END) == 5).count()
