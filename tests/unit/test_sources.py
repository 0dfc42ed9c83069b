"""Files, versioned tables and micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.plans.contract import Contract, Field, Rule
from quern.sources import files, store
from quern.streaming.incremental import apply_batch, stream


@pytest.fixture()
def tables(spark, tmp_path):
    return store.TableStore(spark, str(tmp_path / "tables"))


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_versions_and_snapshots(spark, tables):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert tables.current("t") is None
    assert store.write_snapshot(tables, "t", a) == 1
    assert store.write_snapshot(tables, "t", spark.createDataFrame([(2, None), (1, "x")], "k int, v string")) == 1
    assert store.write_snapshot(tables, "t", a.union(a.limit(1))) == 2
    assert tables.read("t", 1).count() == 2 and tables.read("t").count() == 3
    with pytest.raises(LookupError):
        tables.read("t", 7)
    assert store.write_snapshot(tables, "t", tables.read("t").withColumn("k", F.col("k") + 1)) == 3  # reads what it replaces
    dq = spark.createDataFrame([("pk", 0)], "check string, violations long")
    assert store.publish_batch(tables, {"t": 3}, dq) == 1 and rows(tables.read("_batches"), "table") == [("t", 3)]
    with pytest.raises(ValueError):
        store.publish_batch(tables, {"t": 3}, dq.withColumn("violations", F.lit(2)))


def test_append_once_and_cleanup(spark, tables):
    a = spark.createDataFrame([(1, "s")], "k int, _source_id string")
    assert store.append_once(tables, "b", a, "r1", 0) and not store.append_once(tables, "b", a, "r1", 0)
    assert store.append_once(tables, "b", a, "r2", 0) and tables.read("b").count() == 2
    with pytest.raises(ValueError):
        store.append_once(tables, "b", a.withColumn("k", F.lit(9)), "r1", 0)
    assert store.verify_run(tables.read("b"), "r1", 1).first().ok and not store.verify_run(tables.read("b"), "r1", 2).first().ok
    store.cleanup_run(tables, "b", "r1")
    assert rows(tables.read("b").select("_ingestion_run_id")) == [("r2",)]


def test_only_touched_parts_are_written(spark, tables):
    frame = lambda *r: spark.createDataFrame(list(r), "k int, v string, ts int, _ingestion_run_id string")
    store.append_rows(tables, "t", frame((1, "a", 1, "r1"), (2, "b", 1, "r1")))
    store.append_rows(tables, "t", frame((3, "c", 1, "r2"), (4, None, 1, "r2")))
    one, two = tables.parts("t")
    assert store.upsert_table(tables, "t", frame((1, "a", 1, "r1"), (3, "old", 0, "r2")), ["k"], "ts") == 2  # nothing fresher
    assert store.upsert_table(tables, "t", frame((3, "new", 2, "r3"), (1, "old", 0, "r3"), (9, "z", 1, "r3")), ["k"], "ts") == 3
    assert tables.parts("t")[0] == one and two not in tables.parts("t") and len(tables.parts("t")) == 2
    assert rows(tables.read("t").select("k", "v", "ts")) == [(1, "a", 1), (2, "b", 1), (3, "new", 2), (4, None, 1), (9, "z", 1)]
    assert store.upsert_table(tables, "t", frame((7, "q", 1, "r4")), ["k"], "ts") == 4 and len(tables.parts("t")) == 3
    store.append_rows(tables, "t", spark.createDataFrame([(8, 5)], "k int, more int"))
    assert tables.read("t").filter("k = 8").select("v", "more").first() == (None, 5)
    kept = tables.parts("t")
    store.cleanup_run(tables, "t", "r4")
    assert set(kept) - set(tables.parts("t")) == {kept[2]} and tables.read("t").filter("k = 7").isEmpty()
    assert store.cleanup_run(tables, "t", "none such") == tables.current("t")
    before = rows(tables.read("t"))
    store.compact(tables, "t")
    assert rows(tables.read("t")) == before and len(tables.parts("t")) == 1 and tables.read("t", 2).count() == 4


def test_same_rows(spark):
    a = spark.createDataFrame([(1, None), (1, None), (None, "x")], "k int, v string")
    assert store.same_rows(a, a.orderBy("k")) and not store.same_rows(a, a.limit(2)) and not store.same_rows(a, a.distinct())
    assert not store.same_rows(a, a.withColumnRenamed("v", "w"))


def test_incremental(spark):
    df = spark.createDataFrame([("r1", dt.datetime(2024, 1, 1)), ("r2", dt.datetime(2024, 1, 3))], "_ingestion_run_id string, _ingestion_timestamp timestamp")
    assert store.read_incremental(df, "r1").count() == 1 and store.read_incremental(df, None, "2024-01-02").count() == 1 and store.read_incremental(df, "r1", "2024-01-02").count() == 0
    with pytest.raises(ValueError):
        store.read_incremental(df)
    late = dt.datetime(2025, 1, 1)
    assert store.advance_watermark(df, "_ingestion_timestamp", late).first()[0] == late
    assert store.advance_watermark(df.limit(0), "_ingestion_timestamp", late).first()[0] == late
    assert store.advance_watermark(df, "_ingestion_timestamp").first()[0] == dt.datetime(2024, 1, 3)


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿k,v\n1,\"x,\ny\"\n".encode())
    (tmp_path / "b.csv").write_text("v,w\nz,0\n")
    (tmp_path / "latin.csv").write_bytes("k\né\n".encode("latin-1"))
    a = files.read_csv(spark, str(tmp_path / "a.csv"), expected=["k"])
    assert rows(a) == [("1", "x,\ny")]
    assert files.read_csv(spark, str(tmp_path / "latin.csv"), encoding="ISO-8859-1").first().k == "é"
    both = files.read_union(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert rows(both.select("k", "v", "w"), "w") == [("1", "x,\ny", None), (None, "z", "0")]
    assert both.select("_source_file").distinct().count() == 2
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "b.csv"), expected=["k"])


def test_two_row_header(spark):
    grid = spark.createDataFrame([(0, "note", None, None, None), (1, None, "Rice", "", "Wheat, US"), (2, None, "($/mt)", None, "USD"), (3, "1960M01", "5", None, "1")], "n int, a string, b string, c string, d string")
    flat = files.flatten_two_row_header(grid, "n", 1, 2, 3)
    assert flat.columns == ["period", "rice_mt_", "commodity_2", "wheat_us_usd"] and rows(flat) == [("1960M01", "5", None, "1")]


def test_formats_manifest_and_validation(spark, tmp_path):
    made = {"e.bin": b"", "z.zip": b"PK\x03\x04zz", "o.xls": bytes.fromhex("D0CF11E0A1B11AE1") + b"x", "h.xls": b"\xef\xbb\xbf  <HTML><table>", "c.csv": b"a,b\n1,2\n", "u.bin": b"\x01\x00\x02", "c2.csv": b"a,b\n1,2\n", "j.json": b'{"a":1}\n{bad\n', "p.csv": b"a,b\n1,2\n3,4,5\n"}
    for name, data in made.items():
        (tmp_path / name).write_bytes(data)
    got = {r.path.rsplit("/", 1)[1]: r.format for r in files.classify_files(spark, f"{tmp_path}/*").collect()}
    assert {k: got[k] for k in ("e.bin", "z.zip", "o.xls", "h.xls", "c.csv", "u.bin")} == {"e.bin": "EMPTY", "z.zip": "ZIP", "o.xls": "OLE2", "h.xls": "HTML", "c.csv": "CSV", "u.bin": "UNSUPPORTED"}
    manifest = files.file_manifest(spark, f"{tmp_path}/*")
    assert [r.files for r in files.same_content(manifest).collect()] == [2]
    sources = spark.createDataFrame([("c", r"/c.*\.csv$", 10), ("e", r"/e\.bin$", 0), ("none", "/nothing$", 0)], "source_id string, pattern string, min_bytes int")
    assert {r.source_id: r.ready for r in files.check_readiness(manifest, sources).collect()} == {"c": True, "e": False, "none": False}
    specs = [{"path": str(tmp_path / "c.csv"), "format": "csv", "sha256": "0", "min_rows": 2, "columns": ["a", "zz"]}, {"path": str(tmp_path / "j.json"), "format": "json", "min_rows": 1, "columns": ["a"]}, {"path": str(tmp_path / "p.csv"), "format": "csv"}, {"path": str(tmp_path / "c2.csv"), "format": "csv", "columns": ["a", "b"]}]
    found = {(r.path.rsplit("/", 1)[1], r.problem) for r in files.validate_files(spark, specs).collect()}
    assert found == {("c.csv", "CHECKSUM_MISMATCH"), ("c.csv", "TOO_FEW_RECORDS"), ("c.csv", "MISSING_COLUMNS"), ("j.json", "PARSE_FAILURE"), ("p.csv", "PARSE_FAILURE")}


def test_gates_and_lineage(spark, tmp_path):
    df = spark.createDataFrame([("1", "2.5"), ("3000000000", None)], "a string, b string")
    assert rows(files.numeric_misfits(df, {"a": "int", "b": "int"}), "column") == [("a", "3000000000"), ("b", "2.5")]
    files.assert_numeric_fit(df, {"a": "bigint"})
    with pytest.raises(ValueError):
        files.assert_numeric_fit(df, {"b": "int"})
    wide = df.withColumn("c", F.lit("x"))
    assert files.plan_schema_additions(wide.schema, df.schema, {"c"}) == ["c"] and files.evolve(df, wide.schema).columns == ["a", "b", "c"]
    for bad in (wide.schema, df.withColumn("a", F.lit(1)).schema):
        with pytest.raises(ValueError):
            files.plan_schema_additions(bad, df.schema, set())
    bronze = files.bronze_lineage(df.withColumnRenamed("a", "A b"), "r", "b", 0, "2024-01-01 00:00:00", "s", "f.csv", "0" * 64)
    assert bronze.columns[:2] == ["a_b", "b"] and len(bronze.columns) == 10
    exported = files.export_mart(spark.createDataFrame([(1, 'q"x', None), (2, "", dt.date(2024, 1, 2))], "k int, v string, d date"), str(tmp_path / "mart"))
    assert exported.first().rows == 2


def test_html_table(spark):
    pages = ["<p>x<TABLE><tr><th colspan=2>a &amp; b<tr><td>1<td> 2\n3</table><table><tr><td>no", None, "no table", "<table><tr><td>in<table><tr><td>ner</td></tr></table></td></tr></table>", "<table><td>open"]
    got = rows(files.extract_html_table(spark.createDataFrame(list(enumerate(pages)), "i long, h string"), "i", "h"), "id", "row_no")
    assert got == [(0, 0, ["a & b", "a & b"]), (0, 1, ["1", "2 3"]), (3, 0, ["inner"]), (4, 0, ["open"])]


CONTRACT = Contract("things", (Field("k"), Field("v", "int", nullable=False)), ("k",), (Rule("positive", "v > 0"),))


def test_batches_and_stream(spark, tables, tmp_path):
    day = lambda n: dt.datetime(2024, 1, n)
    schema = "k string, v string, _ts timestamp"
    first = spark.createDataFrame([("a", "1", day(1)), ("a", "2", day(2)), ("b", "-1", day(1)), (None, "3", day(1)), ("c", "x", day(1))], schema)
    done = apply_batch(tables, CONTRACT, first, "run-0", "_ts")
    assert (done["n_rows"], done["n_quarantined"]) == (5, 3) and rows(tables.read("things").select("k", "v")) == [("a", 2)]
    assert apply_batch(tables, CONTRACT, first, "run-0", "_ts")["skipped"] and tables.read("quarantine").count() == 3
    source = str(tmp_path / "source")
    spark.createDataFrame([("a", "5", day(1)), ("d", "7", day(3))], schema).coalesce(1).write.parquet(source)
    for _ in range(2):  # the second time there is nothing new
        stream(spark.readStream.schema(schema).parquet(source), tables, CONTRACT, "_ts", str(tmp_path / "checkpoint"), "s").awaitTermination(120)
        assert rows(tables.read("things").select("k", "v"), "k") == [("a", 2), ("d", 7)]
    assert rows(tables.read("things_runs").select("run_id"), "run_id") == [("run-0",), ("s-0",)]
