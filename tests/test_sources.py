"""Sources, sinks and calls to the outside."""

import pytest
from pyspark.sql import functions as F

from threadloom.sources import fetch, raw, schema, wiki
from threadloom.streaming import ingest


def test_limiter():
    now = [0.0]
    slept = []

    def sleep(s):
        slept.append(s)
        now[0] += s

    limit = fetch.Limiter(2, 100, clock=lambda: now[0], sleep=sleep)
    for _ in range(3):
        limit.take(10)
    assert now[0] >= 60 and slept
    limit.take(95)
    assert now[0] >= 120


def test_retries():
    left = [2]

    def call(x):
        if left[0]:
            left[0] -= 1
            raise OSError("again")
        return x.upper()

    waits = []
    assert fetch.with_retries(call, 3, fetch.linear, False, sleep=waits.append)("a") == "A" and waits == [2.0, 4.0]
    left[0] = 9
    assert fetch.with_retries(call, 2, fetch.exponential, True, sleep=waits.append)("a") is None
    with pytest.raises(OSError):
        fetch.with_retries(call, 1, fetch.exponential, False)("a")
    assert all(0 < fetch.jittered(k) <= 120 for k in range(12))


def test_call_each(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, url string")
    out = fetch.call_each(df, "id", "url", "html", lambda u: f"<p>{u}</p>", calls_per_minute=1000)
    assert sorted(map(tuple, out.collect())) == [(1, "<p>x</p>"), (2, None)]


def test_tables(spark, tmp_path):
    root = f"file://{tmp_path}/db"
    assert set(schema.ensure_tables(spark, root)) == set(schema.TABLES) and schema.ensure_tables(spark, root) == []
    schema.swap_in(spark, root, "pipeline_state", spark.sql("select 'a' as name, current_date() as last_on, '1' as last_id"))
    assert spark.read.parquet(f"{root}/pipeline_state").count() == 1


def test_prefix_scan_and_patch(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in/a/b")
    rows = raw.scan_prefix(spark, f"{tmp_path}/in")
    assert rows.count() == 3
    patched = raw.patch_columns(rows, {"question_id": "", "created_at": None})
    assert patched.columns == ["id", "question_id", "created_at"]
    times = raw.to_utc(spark.createDataFrame([("2024-01-01",), ("x",)], "t string"), "t").collect()
    assert times[0][0] is not None and times[1][0] is None


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\n,c', "x")], "id long, body string, more string")
    raw.write_csv(df, f"{tmp_path}/c", ["id", "body"])
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{tmp_path}/c").collect()
    assert back[0]["body"] == 'a "b"\n,c' and back[0].__fields__ == ["id", "body"]


def test_wiki_plan(spark):
    pages = spark.createDataFrame([("kb\\a//b?x=1", "1"), ("/kb", "2")], "path string, content string")
    got = {r["path"]: (r["stub"], r["depth"]) for r in wiki.upsert_plan(pages).collect()}
    assert got == {"/kb/a/b": (False, 3), "/kb": (False, 1), "/kb/a": (True, 2)}


def test_incremental_runs_take_files_once(spark, tmp_path):
    source, target, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    spark.range(5).write.parquet(source)
    run = lambda: ingest.run_available(spark, source, "id long", lambda s: s.where("id % 2 = 0"), target, state)
    run()
    spark.range(100, 104).write.mode("append").parquet(source)
    run()
    run()
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == [0, 2, 4, 100, 102]


def test_windows_in_a_stream(spark, tmp_path):
    rows = spark.sql("select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) as ts, 'a' as event_type, cast(id as double) as value from range(30)")
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = ingest.event_windows(stream).writeStream.format("memory").queryName("wins").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("wins").collect())) == sorted(map(tuple, ingest.event_windows(rows).collect()))


def test_silence(spark):
    df = spark.sql("select 1L as incident_id, cast(id as string) as thread_id, date'2024-01-01' + cast(id * id as int) as added_on from range(5)")
    got = [r["stretch"] for r in ingest.split_by_silence(df).orderBy("added_on").collect()]
    assert got == [0, 0, 0, 1, 2]
    assert df.where(F.lit(True)).count() == 5


def test_xlsx_and_upload(spark, tmp_path):
    import xml.etree.ElementTree as ET
    import zipfile

    from threadloom.sources import raw

    rows = [("qa1", "a < b & c", "http://x", "2024-01-01 00:00:00", None, "two\nlines \x01"), ("qa2", "é", None, "", "me", "")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in raw.SHEET))
    path = str(tmp_path / "t.xlsx")
    assert raw.write_xlsx(df, path) == 2
    ns = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
    with zipfile.ZipFile(path) as z:
        sheet = ET.fromstring(z.read("xl/worksheets/sheet1.xml"))
        assert {"[Content_Types].xml", "_rels/.rels", "xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= set(z.namelist())
    cells = [[c.find("m:is/m:t", ns).text or "" for c in r] for r in sheet.iterfind("m:sheetData/m:row", ns)]
    assert cells == [raw.SHEET, *([("" if x is None else x.replace("\x01", "")) for x in r] for r in rows)]
    import pytest

    with pytest.raises(ValueError):
        raw.write_xlsx(df, path, most=1)

    folder = tmp_path / "up"
    folder.mkdir()

    def put(name, body):
        (folder / name).write_bytes(body)

    done = []
    n = raw.upload(spark.createDataFrame([("a", "x"), ("b", "é"), (None, "z"), ("c", None)], "name string, content string"), put, lambda: done.append(len(list(folder.iterdir()))))
    assert n == 2 and done == [2] and (folder / "b").read_bytes() == "é".encode()
