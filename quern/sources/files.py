"""Raw files: scans, classification, manifests, validation, and typed export."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.clean import sanitize
from quern.operators.sets import CHUNK, shared_members
from quern.sources.ranges import file_ranges, read_layouts
from quern.sources.store import LINEAGE, same_rows


def read_csv(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", expected: list[str] | None = None) -> DataFrame:
    """All columns as text, a byte order mark taken off; a header without the expected columns is an error."""
    df = spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).option("escape", '"').csv(path)
    names = [c.replace("﻿", "").strip() for c in df.columns]
    if clash := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"header columns collide: {clash}")
    if lacking := sorted(set(expected or ()) - set(names)):
        raise ValueError(f"expected columns are missing: {lacking}")
    return df.toDF(*names)


def read_union(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """Files of different headers as one table of text, absent columns NULL, with _source_file; see ranges.read_layouts."""
    return read_layouts(spark, paths, **options)


def flatten_two_row_header(grid: DataFrame, number: str, name_row: int, unit_row: int, first_data_row: int) -> DataFrame:
    """A grid with row numbers whose names and units stand in two rows: columns become `name unit`, the first `period`,
    blank names Commodity_<i>. Only the two header rows come to the driver."""
    cells = [c for c in grid.columns if c != number]
    rows = {r[number]: r for r in grid.filter(F.col(number).isin(name_row, unit_row)).limit(2).collect()}
    names = ["period"]
    for i, c in enumerate(cells[1:], 1):
        name, unit = ((rows[n][c] or "").strip() for n in (name_row, unit_row))
        names.append(f"{name or f'Commodity_{i}'} {unit}".strip())
    return grid.filter(F.col(number) >= first_data_row).select(*cells).toDF(*(sanitize(n) for n in names))


def classify_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length, format) by leading bytes: EMPTY, ZIP, OLE2, HTML, CSV or UNSUPPORTED."""
    head = F.col("head")
    text = F.lower(F.ltrim(F.regexp_replace(F.decode(head, "ISO-8859-1"), "^ï»¿", "")))
    kind = (
        F.when(F.col("length") == 0, "EMPTY").when(F.hex(head).startswith("504B0304"), "ZIP").when(F.hex(head).startswith("D0CF11E0A1B11AE1"), "OLE2")
        .when(text.startswith("<!doctype html") | text.startswith("<html") | text.startswith("<table") | text.contains("<table"), "HTML")
        .when(F.hex(head).rlike("^(..)*00"), "UNSUPPORTED").when(F.regexp_extract(text, "^[^\r\n]*", 0).rlike("[,;\t|]"), "CSV").otherwise("UNSUPPORTED")
    )
    return file_ranges(spark, paths).select("path", "length", kind.alias("format"))


def file_manifest(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, bytes, sha256) of every file; the digest streams through files of any size."""
    return file_ranges(spark, paths, "digest").select("path", F.col("length").alias("bytes"), "sha256")


def same_content(manifest: DataFrame) -> DataFrame:
    """Contents that more than one file has."""
    return manifest.groupBy("sha256").agg(F.count("*").alias("files"), F.sort_array(F.collect_set("path")).alias("paths")).filter("files > 1")


def same_content_chunks(manifest: DataFrame, size: int = CHUNK) -> DataFrame:
    """(sha256, chunk, n, items, digest): the same for contents that any number of files have, their paths in chunks."""
    return shared_members(manifest, ["sha256"], "path", size)


def check_readiness(manifest: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source (source_id, pattern, min_bytes): files, bytes, and ready if there are files, none empty, enough bytes."""
    hit = sources.join(manifest, F.rlike(manifest["path"], sources["pattern"]), "left")
    out = hit.groupBy("source_id", "min_bytes").agg(F.count("path").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("bytes") == 0).alias("empty_files"))
    return out.withColumn("ready", (F.col("files") > 0) & (F.col("empty_files") == 0) & (F.col("bytes") >= F.col("min_bytes")))


def validate_files(spark: SparkSession, specs: list[dict]) -> DataFrame:
    """(path, problem, detail) per problem found in files {path, format csv|json, sha256, min_rows, columns}: EMPTY,
    CHECKSUM_MISMATCH, PARSE_FAILURE, TOO_FEW_RECORDS, MISSING_COLUMNS. A path may be a folder, which is empty if all its
    files are: Spark writes a file without a byte where its first task had no rows."""
    out = []
    for s in specs:
        path = F.lit(s["path"]).alias("path")
        facts = file_manifest(spark, s["path"])
        out.append(facts.agg(F.sum("bytes").alias("bytes")).filter("bytes = 0").select(path, F.lit("EMPTY").alias("problem"), F.lit("").alias("detail")))
        if s.get("sha256"):
            out.append(facts.filter(F.col("sha256") != s["sha256"]).select(path, F.lit("CHECKSUM_MISMATCH").alias("problem"), F.col("sha256").alias("detail")))
        if s["format"] == "csv":
            header = read_csv(spark, s["path"]).columns
            schema = ", ".join([*(f"`{c}` string" for c in header), "_corrupt string"])
            rows = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("columnPruning", False).csv(s["path"])
            rows = rows.withColumn("value", F.concat_ws("", *(f"`{c}`" for c in header)))
        else:
            lines = spark.read.text(s["path"]).filter("trim(value) <> ''")
            rows = lines.select(F.when(F.try_parse_json("value").isNull(), F.col("value")).alias("_corrupt"), "value")
            keys = lines.select(F.explode(F.json_object_keys("value")).alias("name")).distinct()
        counted = rows.agg(F.count("*").alias("n"), F.count_if(F.col("_corrupt").isNotNull() & (F.length("value") >= 0)).alias("bad"))  # the length makes the reader parse whole rows
        out.append(counted.filter("bad > 0").select(path, F.lit("PARSE_FAILURE").alias("problem"), F.col("bad").cast("string").alias("detail")))
        out.append(counted.filter(F.col("n") - F.col("bad") < s.get("min_rows", 1)).select(path, F.lit("TOO_FEW_RECORDS").alias("problem"), (F.col("n") - F.col("bad")).cast("string").alias("detail")))
        if s.get("columns"):
            if s["format"] == "csv":
                keys = spark.createDataFrame([(c,) for c in header], "name string")
            lacking = spark.createDataFrame([(c,) for c in s["columns"]], "name string").join(keys, "name", "left_anti")
            names = lacking.agg(F.array_join(F.sort_array(F.collect_list("name")), ",").alias("detail")).filter("detail <> ''")
            out.append(names.select(path, F.lit("MISSING_COLUMNS").alias("problem"), "detail"))
    return reduce(DataFrame.unionByName, out)


class _FirstTable(HTMLParser):
    """Cells of the first table of a page; tables inside its cells count as text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.done, self.rows, self.cell, self.span = 0, False, [], None, 1

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and not self.done:
            if tag == "tr":
                self._close()
                self.rows.append([])
            elif tag in ("td", "th"):
                self._close()
                span = dict(attrs).get("colspan") or "1"
                self.cell, self.span = [], int(span) if span.isdigit() else 1

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self._close()
                self.done = True
        elif tag in ("td", "th", "tr") and self.depth == 1:
            self._close()

    def handle_data(self, data):
        if self.cell is not None and not self.done:
            self.cell.append(data)

    def _close(self):
        if self.cell is not None:
            if not self.rows:
                self.rows.append([])
            self.rows[-1] += [" ".join("".join(self.cell).split())] * min(self.span, 1000)  # as the standard has it: no cell spans more
            self.cell = None


def extract_html_table(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, row_no, cells) of the first table of every page; pages without one, and NULL pages, give no rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, numbers, cells = [], [], []
            for i, page in zip(frame["id"], frame["html"]):
                if not page or "<table" not in page.lower():
                    continue
                parser = _FirstTable()
                parser.feed(page)
                parser.close()
                parser._close()
                for n, row in enumerate(r for r in parser.rows if r):
                    ids.append(i), numbers.append(n), cells.append(row)
            yield pd.DataFrame({"id": pd.Series(ids, dtype="Int64"), "row_no": pd.Series(numbers, dtype="int32"), "cells": pd.Series(cells, dtype=object)})

    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html")).mapInPandas(run, "id long, row_no int, cells array<string>")


def bronze_lineage(df: DataFrame, run_id: str, batch_id: str, chunk_id: int, at: str, source_id: str, source_file: str, checksum: str, snapshot_id: int | None = None) -> DataFrame:
    """Sanitized source columns and the eight lineage columns; a source column of such a name is an error."""
    from quern.functions.clean import sanitize_columns

    clean = sanitize_columns(df)
    if clash := sorted(set(clean.columns) & {c.lstrip("_") for c in LINEAGE} | set(clean.columns) & set(LINEAGE)):
        raise ValueError(f"source columns collide with lineage: {clash}")
    values = (F.lit(run_id), F.lit(batch_id), F.lit(chunk_id).cast("long"), F.lit(at).cast("timestamp"), F.lit(source_id), F.lit(source_file), F.lit(checksum), F.lit(snapshot_id).cast("long"))
    return clean.withColumns(dict(zip(LINEAGE, values)))


RANGES = {"int": (-(2**31), 2**31 - 1), "bigint": (-(2**63), 2**63 - 1), "smallint": (-(2**15), 2**15 - 1)}


def numeric_misfits(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column, value) of values that are fractional or out of range for the integer type their column is to have."""
    parts = []
    for c, kind in types.items():
        v = F.col(c).try_cast("decimal(38,10)")
        low, high = RANGES[kind]
        bad = F.col(c).isNotNull() & (v.isNull() | (v != F.floor(v)) | ~v.between(F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(high)).cast("decimal(38,0)")))
        parts.append(F.when(bad, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))))
    return df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("m")).select("m.*")


def assert_numeric_fit(df: DataFrame, types: dict[str, str]) -> None:
    if found := numeric_misfits(df, types).limit(1).collect():
        raise ValueError(f"value does not fit: {found[0].column}={found[0].value}")


def plan_schema_additions(incoming: T.StructType, existing: T.StructType, approved: set[str]) -> list[str]:
    """New columns to add: only approved ones, of text; another type for a known column is an error."""
    old = {f.name: f.dataType for f in existing}
    if changed := [f.name for f in incoming if f.name in old and f.dataType != old[f.name]]:
        raise ValueError(f"column types changed: {changed}")
    new = [f for f in incoming if f.name not in old]
    if refused := [f.name for f in new if f.name not in approved or f.dataType != T.StringType()]:
        raise ValueError(f"columns are not approved: {refused}")
    return [f.name for f in new]


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the columns of schema that it lacks as typed NULLs, in that order."""
    return df.select(*(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def export_mart(df: DataFrame, path: str, schema: str | None = None) -> DataFrame:
    """Writes a mart as CSV, reads it back under its schema and compares every row: manifest of files with row count."""
    spark = df.sparkSession
    nulls = {"nullValue": "\\N", "header": True, "escape": '"', "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    df.write.mode("errorifexists").options(**nulls).csv(path)
    back = spark.read.options(**nulls).schema(schema or df.schema).csv(path)
    if not same_rows(df, back):
        raise IOError(f"{path} does not read back as written")
    return file_manifest(spark, path).withColumn("rows", F.lit(df.count()))
