"""A stream whose files change their columns."""

import json

from pyspark.sql import functions as F

from lakeloom.streaming.evolving import kept_schema, read_evolving, stream_evolving


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def by_id(df):
    return {r.id: r.asDict() for r in df.collect()}


def test_new_and_mistyped_columns_lose_nothing(spark, tmp_path):
    folder, check, target = tmp_path / "in", str(tmp_path / "check"), str(tmp_path / "bronze")
    drop(folder, "a.json", {"id": 1, "score": 1.5}, {"id": 2, "score": None})
    first = stream_evolving(spark, str(folder), check, target)
    assert dict(first.dtypes) == {"id": "bigint", "score": "double", "source_file": "string", "rescued": "map<string,string>"}
    assert by_id(first)[1] == {"id": 1, "score": 1.5, "source_file": "a.json", "rescued": None}

    drop(folder, "b.json", {"id": 3, "score": "n/a", "city": "Rome"}, {"id": 4, "score": 2, "city": None, "more": {"x": [1, 2]}},
         {"id": 5, "Score": 7, "rescued": "r", "batch": 9, "none": None})
    second = stream_evolving(spark, str(folder), check, target)
    rows = by_id(second)
    assert second.columns == ["id", "score", "city", "more", "source_file", "rescued"] and len(rows) == 5
    assert rows[1]["city"] is None and rows[3]["city"] == "Rome" and rows[3]["score"] is None and rows[3]["rescued"] == {"score": "n/a"}
    assert json.loads(rows[4]["more"]) == {"x": [1, 2]} and rows[4]["score"] == 2.0 and rows[4]["rescued"] is None
    assert rows[5]["rescued"] == {"Score": "7", "rescued": "r", "batch": "9"}

    again = stream_evolving(spark, str(folder), check, target)
    assert again.count() == 5 and kept_schema(spark, check).names == ["id", "score", "city", "more"]
    assert spark.read.text(f"{check}_versions").count() == 2


def test_broken_and_blank_lines_and_a_given_schema(spark, tmp_path):
    folder, check, target = tmp_path / "in", str(tmp_path / "check"), str(tmp_path / "bronze")
    folder.mkdir()
    assert stream_evolving(spark, str(folder), check, target, "id int, when date").isEmpty()
    drop(folder, "a.json", {"id": 1, "when": "2024-02-01"}, "", "   ", "{broken", {"id": "one", "when": "soon"}, "[3]")
    found = stream_evolving(spark, str(folder), check, target, "id int, when date").collect()
    assert len(found) == 4 and [str(r.when) for r in found if r.id == 1] == ["2024-02-01"]
    assert {tuple(sorted((r.rescued or {}).items())) for r in found} == {
        (), (("_line", "{broken"),), (("id", "one"), ("when", "soon")), (("_line", "[3]"),)}


def test_a_repeated_batch_is_written_over(spark, tmp_path):
    folder, check, target = tmp_path / "in", str(tmp_path / "check"), str(tmp_path / "bronze")
    drop(folder, "a.json", *[{"id": i, "v": i} for i in range(50)])
    stream_evolving(spark, str(folder), check, target)
    (tmp_path / "check" / "commits" / "0").unlink()  # as if the run had ended before its commit
    for hidden in (tmp_path / "check" / "commits").glob(".0.crc"):
        hidden.unlink()
    stream_evolving(spark, str(folder), check, target)
    found = read_evolving(spark, check, target)
    assert found.count() == 50 and found.agg(F.countDistinct("id")).first()[0] == 50
