import json
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType

from lakeloom.sinks import files as out
from lakeloom.sources import files, paged, workbook
from lakeloom.streaming.files import stream_checkpoint, stream_files


def test_embedded_comma_pipe_and_newline(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name\n1,"Doe, John"\n2,"two\nlines"\n3,plain\n')
    rows = files.read_delimited(spark, str(tmp_path / "a.csv"), multiline=True).collect()
    assert [(r.id, r.name) for r in rows] == [("1", "Doe, John"), ("2", "two\nlines"), ("3", "plain")]
    (tmp_path / "b.txt").write_text('id|grade\r\n1|"A|provisional"\n2|B\n')
    rows = files.read_delimited(spark, str(tmp_path / "b.txt"), sep="|").collect()
    assert [(r.id, r.grade) for r in rows] == [("1", "A|provisional"), ("2", "B")]


def test_upload_keeps_bad_lines(spark, tmp_path):
    (tmp_path / "u.csv").write_text("dept_id,score\n1,2.5\n2,n/a\n999,1.0\n")
    schema = StructType().add("dept_id", LongType()).add("score", DoubleType())
    rows = {r.dept_id: (r.score, r[files.CORRUPT]) for r in files.read_upload(spark, str(tmp_path / "u.csv"), schema).collect()}
    assert rows == {1: (2.5, None), 2: (None, "2,n/a"), 999: (1.0, None)}
    inferred = files.read_upload(spark, str(tmp_path / "u.csv"))
    assert dict(inferred.dtypes) == {"dept_id": "int", "score": "string"}


def test_optional_json_key_and_xml_node(spark, tmp_path):
    rows = [{"id": 1, "tags": [{"a": 1, "b": [1, 2]}]}, {"id": 2, "pre": "x", "tags": []}]
    (tmp_path / "j.json").write_text("\n".join(map(json.dumps, rows)))
    assert {(r.id, r.pre) for r in files.read_json(spark, str(tmp_path / "j.json")).collect()} == {(1, None), (2, "x")}
    (tmp_path / "x.xml").write_text("<fac><m><id>1</id><tenure>true</tenure></m><m><id>2</id></m></fac>")
    assert {(r.id, r.tenure) for r in files.read_xml(spark, str(tmp_path / "x.xml"), "m").collect()} == {(1, True), (2, None)}


def foreign_workbook(path):
    """As other programs write them: shared strings, cell references with gaps, target second."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Summary" sheetId="1" r:id="r1"/>'
                                      '<sheet name="AidDetail" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                                 '<Relationship Id="r1" Target="worksheets/s1.xml"/><Relationship Id="r2" Target="/xl/worksheets/s2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>aid_id</t></si><si><t>kind</t></si><si><r><t>gr</t></r><r><t>ant</t></r></si>'
                                           '<si><t>paid_on</t></si></sst>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet xmlns="{main}"><sheetData><row><c r="A1" t="s"><v>0</v></c></row><row><c r="A2"><v>7</v></c></row></sheetData></worksheet>')
        z.writestr("xl/worksheets/s2.xml", f'<worksheet xmlns="{main}"><sheetData>'
                   '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>3</v></c></row>'
                   '<row><c r="A2"><v>1</v></c><c r="B2" t="s"><v>2</v></c><c r="D2"><v>45292</v></c></row>'
                   '<row><c r="A3"><v>2</v></c><c r="D3"><v>45293</v></c></row></sheetData></worksheet>')


def test_named_sheet_of_foreign_workbooks(spark, tmp_path):
    import datetime as dt

    for n in range(3):
        foreign_workbook(tmp_path / f"w{n}.xlsx")
    schema = StructType().add("aid_id", LongType()).add("kind", StringType()).add("paid_on", DateType())
    rows = workbook.read_workbooks(spark, str(tmp_path), "AidDetail", schema).collect()
    assert len(rows) == 6
    assert {tuple(r) for r in rows} == {(1, "grant", dt.date(2024, 1, 1)), (2, None, dt.date(2024, 1, 2))}
    assert workbook.read_workbooks(spark, str(tmp_path), "Missing", schema).count() == 0


def test_workbook_round_trip_over_full_sheets(spark, tmp_path):
    import datetime as dt

    day = dt.date(2020, 2, 29)
    rows = [(i, "hot" if i % 3 else "b&<c>", i / 8 if i % 5 else None, day, bool(i % 2)) for i in range(250)]
    df = spark.createDataFrame(rows, "id long, kind string, x double, day date, ok boolean")
    made = workbook.export_workbooks(df, str(tmp_path / "x"), "Data", "kind", cover={"Summary": [("a", 1)]}, max_rows=40)
    assert made.agg(F.sum("rows")).first()[0] == 250 and made.filter("rows > 40").count() == 0
    back = workbook.read_workbooks(spark, str(tmp_path / "x"), "Data", df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def write_pages(root, total, size):
    for page in range(1, -(-total // size) + 1):
        folder = root / f"page={page}"
        folder.mkdir(parents=True)
        ids = range((page - 1) * size, min(page * size, total))
        (folder / "p.json").write_text("\n".join(json.dumps({"id": i, "name": f"n{i}"}) for i in ids))


def test_paged_extract_survives_an_expired_token(spark, tmp_path):
    write_pages(tmp_path, 2345, 100)
    fetcher = paged.FilePages(str(tmp_path), 100, 2345, expire_at=7)
    rows = paged.read_pages(spark, fetcher, "id long, name string", page_size=100, parallel=3)
    assert paged.require_complete(rows, 2345) == 2345
    assert rows.select("id").distinct().count() == 2345
    with pytest.raises(ValueError):
        paged.require_complete(rows, 2346)
    session = paged._Session(fetcher)
    assert sum(len(session.get(p, 100)[0]) for p in range(1, 25)) == 2345
    assert fetcher.logins == 2


def test_dated_files_once_each(spark, tmp_path):
    drop, work = tmp_path / "drop", str(tmp_path / "work")
    drop.mkdir()

    def put(day, n=200):
        (drop / f"financial_aid_{day}.csv").write_text("aid_id,amount\n" + "\n".join(f"{day}{i:03d},{i}.5" for i in range(n)))

    for day in ("20240101", "20240102", "20240103"):
        put(day)
    (drop / "other.csv").write_text("aid_id,amount\n1,1\n")

    def run():
        return stream_files(spark, "csv", str(drop), stream_checkpoint(work, "me@x", "aid"), work + "/bronze",
                            glob="financial_aid_*.csv").count()

    assert (run(), run()) == (600, 600)
    put("20240104")
    assert run() == 800
    dated = files.read_dated(spark, str(drop), "financial_aid_*.csv", "aid_id long, amount double")
    assert dated.groupBy("file_date").count().count() == 4 and dated.filter("file_date IS NULL").count() == 0
    assert stream_checkpoint("/c", "a.b@c", "s") == "/c/a_b_c/s"


def test_pages_of_a_table(spark):
    df = spark.range(250)
    last = files.page(df, "id", 3, 100).collect()
    assert [r.id for r in last] == list(range(200, 250)) and not last[0].has_next
    assert files.page(df, "id", 2, 100).first().has_next
    assert [r.id for r in files.keyset_page(df, "id", 99, 3).collect()] == [100, 101, 102]


def test_single_file_name_and_siblings(spark, tmp_path):
    df = spark.range(50).repartition(4)
    one = out.export_single_file(df, str(tmp_path / "ids.txt"), sep="|")
    assert one == [str(tmp_path / "ids.txt")] and len((tmp_path / "ids.txt").read_text().split()) == 51
    many = out.export_single_file(df, str(tmp_path / "big.txt"), sep="|", single=False)
    assert len(many) == 4
    assert spark.read.option("header", True).csv(many).count() == 50
    again = out.export_single_file(df.limit(5), str(tmp_path / "big.txt"), sep="|")
    assert [str(p) for p in tmp_path.glob("big*")] == again


def test_json_and_xml_leave_nulls_out(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "y")], "id int, note string")
    out.export_json(df, str(tmp_path / "j"))
    text = "".join(p.read_text() for p in (tmp_path / "j").glob("part-*"))
    assert '{"id":1}' in text and '"note":"y"' in text
    out.export_xml(df, str(tmp_path / "x"), "r", "root")
    assert files.read_xml(spark, str(tmp_path / "x"), "r", "id int, note string").filter("note IS NULL").count() == 1


def test_mark_moves_on(spark):
    df = spark.range(10)
    rows, mark = files.changed_since(df, "id", 6)
    assert rows.count() == 3 and rows.agg(mark).first()[0] == 9
