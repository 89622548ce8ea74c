import pytest
from pyspark.sql import functions as F

from lakeloom.operators import cdc
from lakeloom.sinks.tables import VersionedTable, merge_partitions, merge_upsert
from lakeloom.streaming.cdc import announce, apply_snapshot, stream_snapshots

SHAPE = "id long, dept long, status string"


def people(spark, n=1000):
    return spark.range(n).select("id", (F.col("id") % 25).alias("dept"),
                                 F.when(F.col("id") % 4 == 0, "graduated").otherwise("active").alias("status"))


def test_planted_changes_are_found(spark):
    v1 = people(spark)
    v2 = cdc.plant_changes(v1, "id", 10, 20, 5, 900_000)
    assert v2.count() == 1005
    counts = {r.change: r["count"] for r in cdc.diff_snapshots(v1, v2, ["id"]).groupBy("change").count().collect()}
    # 5 of the 20 flips are on rows that already had the new status.
    assert counts == {"insert": 10, "update": 15, "delete": 5}
    images = {r._change_type: r["count"] for r in cdc.change_log(v1, v2, ["id"], 2).groupBy("_change_type").count().collect()}
    assert images == {"insert": 10, "update_preimage": 15, "update_postimage": 15, "delete": 5}


def test_scd_counts(spark):
    v1 = people(spark)
    v2 = cdc.plant_changes(v1, "id", 10, 20, 5, 900_000)
    assert cdc.scd1(v1, v2, ["id"]).exceptAll(v2).count() == 0
    assert cdc.scd1(v1, v2, ["id"]).count() == 1005
    history = cdc.scd2(cdc.scd2_start(v1, 1), v2, 2, ["id"])
    assert history.filter(F.col(cdc.END).isNull()).count() == 1005
    assert history.filter(F.col(cdc.END).isNotNull()).count() == 15 + 5
    current = history.filter(F.col(cdc.END).isNull()).drop(cdc.START, cdc.END)
    assert current.exceptAll(v2).count() == 0


def snapshots(spark):
    rows = {1: [(1, 1, "a"), (2, 1, None), (3, 1, "c")], 2: [(1, 1, "a"), (2, 1, "b")],
            3: [(1, 1, "a"), (2, 1, "b"), (3, 1, "c")]}
    return [(spark.createDataFrame(r, SHAPE), v) for v, r in rows.items()]


WANT = {(1, 1, "a", 1, None), (2, 1, None, 1, 2), (2, 1, "b", 2, None), (3, 1, "c", 1, 2), (3, 1, "c", 3, None)}


def test_reappearing_key_and_null_change(spark):
    (v1, _), (v2, _), (v3, _) = snaps = snapshots(spark)
    step = cdc.scd2(cdc.scd2(cdc.scd2_start(v1, 1), v2, 2, ["id"]), v3, 3, ["id"])
    assert {tuple(r) for r in step.collect()} == WANT
    assert {tuple(r) for r in cdc.scd2_from(snaps, ["id"]).collect()} == WANT


def test_applied_versions_are_skipped(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for df, version in snapshots(spark) + snapshots(spark)[:2]:
        apply_snapshot(table, df, version, ["id"], 2)
    assert {tuple(r) for r in table.read().collect()} == WANT
    assert [r.version for r in table.history().orderBy("version").collect()] == [1, 2, 3]


@pytest.mark.parametrize("kind", [1, 2])
def test_stream_keeps_history(spark, tmp_path, kind):
    snaps = snapshots(spark)
    schema = snaps[0][0].withColumn("snapshot_version", F.lit(1)).schema
    for df, version in snaps:
        df.withColumn("snapshot_version", F.lit(version)).write.mode("append").parquet(str(tmp_path / "in"))
        announce(spark, str(tmp_path / "in"), version, df.count())
        for _ in range(2):
            table = stream_snapshots(spark, str(tmp_path / "in"), schema, str(tmp_path / "cp"), str(tmp_path / "t"), ["id"], kind)
    got = {tuple(r) for r in table.read().collect()}
    assert got == (WANT if kind == 2 else {(1, 1, "a"), (2, 1, "b"), (3, 1, "c")})


def test_feed_order(spark):
    feed = cdc.SnapshotFeed({3: "c", 1: "a"})
    assert feed.next(None) == ("a", 1) and feed.next(1) == ("c", 3) and feed.next(3) is None


def test_duplicate_source_keys_are_refused(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], SHAPE)
    with pytest.raises(ValueError):
        merge_upsert(rows, rows, ["id"])


def test_merge_and_delete_keep_nulls(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "m"))
    table.commit(spark.createDataFrame([(1, 1, "a"), (2, 1, None)], SHAPE), "SEED")
    table.merge(spark.createDataFrame([(2, 5, "x"), (3, 1, "y")], SHAPE), ["id"])
    table.delete(F.col("status") == "y")
    assert {tuple(r) for r in table.read().collect()} == {(1, 1, "a"), (2, 5, "x")}
    assert {tuple(r) for r in table.read(0).collect()} == {(1, 1, "a"), (2, 1, None)}
    assert [r.operation for r in table.history().orderBy("version").collect()] == ["SEED", "MERGE", "DELETE"]


def brute_history(states):
    """Rows of type 2 history from a list of {key: row} states with versions 1, 2, ..."""
    out, open_rows = set(), {}
    for version, state in enumerate(states, 1):
        for key in list(open_rows):
            row, start = open_rows[key]
            if state.get(key) != row:
                out.add((key, *row, start, version))
                del open_rows[key]
        for key, row in state.items():
            open_rows.setdefault(key, (row, version))
    return out | {(key, *row, start, None) for key, (row, start) in open_rows.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories(spark, seed):
    import random

    rnd = random.Random(seed)
    states = [{k: (rnd.randrange(2), rnd.choice([None, "a"])) for k in range(12) if rnd.random() < 0.7} for _ in range(4)]
    snaps = [(spark.createDataFrame([(k, *row) for k, row in s.items()], SHAPE), v) for v, s in enumerate(states, 1)]
    want = brute_history(states)
    history = cdc.scd2_start(*snaps[0])
    for df, version in snaps[1:]:
        history = cdc.scd2(history, df, version, ["id"])
    assert {tuple(r) for r in history.collect()} == want
    assert {tuple(r) for r in cdc.scd2_from(snaps, ["id"]).collect()} == want
    for (old, _), (new, _), a, b in zip(snaps, snaps[1:], states, states[1:]):
        kinds = {r.id: r.change for r in cdc.diff_snapshots(old, new, ["id"]).collect()}
        assert kinds == {k: "insert" if k not in a else "delete" if k not in b else "update"
                         for k in a.keys() | b.keys() if a.get(k) != b.get(k)}


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    from lakeloom.sinks.tables import merge_partitions, replace_partition

    path = tmp_path / "p"
    rows = spark.range(100).select("id", (F.col("id") % 4).alias("part"), F.lit("old").alias("v"))
    replace_partition(rows, str(path), "part")
    before = {p: {f.name for f in (path / f"part={p}").glob("*.parquet")} for p in range(4)}
    change = spark.createDataFrame([(1, 1, "new"), (1001, 1, "new")], "id long, part long, v string")
    merged = merge_partitions(str(path), change, ["id"], "part")
    after = {p: {f.name for f in (path / f"part={p}").glob("*.parquet")} for p in range(4)}
    assert before[1] != after[1] and all(before[p] == after[p] for p in (0, 2, 3))
    assert merged.count() == 101 and merged.filter("v = 'new'").count() == 2
    replace_partition(change, str(path), "part")
    assert replace_partition(change, str(path), "part").count() == 77


def test_schema_changes_are_logged(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "s"))
    table.commit(spark.createDataFrame([(1, 1, "a")], SHAPE), "CREATE")
    table.commit(spark.createDataFrame([(1, "x", 2)], "id long, dept string, extra int"), "REPLACE")
    rows = {(r.version, r.column_name, r.change, r.old_type, r.new_type) for r in table.schema_history().collect()}
    assert rows == {(1, "extra", "add", None, "int"), (1, "status", "drop", "string", None), (1, "dept", "retype", "bigint", "string")}
    assert table.schema_history().filter("user_name IS NULL OR at IS NULL").count() == 0


def test_split_snapshot_waits_for_its_rest(spark, tmp_path):
    (first, _), (second, _), _ = snapshots(spark)
    tagged = lambda df, v: df.withColumn("snapshot_version", F.lit(v))
    schema = tagged(first, 1).schema

    def drop(df, v, rows=None):
        tagged(df, v).write.mode("append").parquet(str(tmp_path / "in"))
        if rows:
            announce(spark, str(tmp_path / "in"), v, rows)
        return stream_snapshots(spark, str(tmp_path / "in"), schema, str(tmp_path / "cp"), str(tmp_path / "t"), ["id"], 1).version()

    assert drop(first.filter("id < 3"), 1) == -1
    assert drop(second.filter("id = 1"), 2, 2) == -1
    assert drop(first.filter("id = 3"), 1, 3) == 1
    assert drop(second.filter("id = 2"), 2) == 2
    assert {r.id for r in VersionedTable(spark, str(tmp_path / "t")).read().collect()} == {1, 2}


def test_added_and_dropped_columns(spark):
    old = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SHAPE)
    new = spark.createDataFrame([(1, 1, "x"), (2, 1, None)], "id long, dept long, email string")
    changes = {r.id: r for r in cdc.diff_snapshots(old, new, ["id"]).collect()}
    assert changes[1].change == "update" and changes[1].old.email is None and changes[1].new.email == "x" and changes[1].new.status is None
    assert cdc.scd1(old, new, ["id"]).columns == ["id", "dept", "email"]
    history = cdc.scd2(cdc.scd2_start(old, 1), new, 2, ["id"])
    assert {(r.id, r.status, r.email, r[cdc.START], r[cdc.END]) for r in history.collect()} == {
        (1, "a", None, 1, 2), (1, None, "x", 2, None), (2, "b", None, 1, 2), (2, None, None, 2, None)}
    assert {tuple(r) for r in cdc.scd2_from([(old, 1), (new, 2)], ["id"]).select(*history.columns).collect()} == {tuple(r) for r in history.collect()}


def test_merge_keeps_null_partitions_and_moves_keys(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "x"), (4, "d", "y"), (5, "e", "z")], "id long, v string, part string").write.partitionBy("part").parquet(path)
    source = spark.createDataFrame([(1, "new", None), (4, "moved", "x"), (6, "f", "w")], "id long, v string, part string")
    got = {tuple(r) for r in merge_partitions(path, source, ["id"], "part").select("id", "v", "part").collect()}
    assert got == {(1, "new", None), (2, "b", None), (3, "c", "x"), (4, "moved", "x"), (5, "e", "z"), (6, "f", "w")}
