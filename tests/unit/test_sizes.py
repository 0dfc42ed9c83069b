"""Cases of odd inputs, and of what grows with the table."""

import os

from pyspark.sql import functions as F

from quern import queries as core
from quern import source_queries, structure_queries
from quern.operators import ledger, profile
from quern.plans import facts
from quern.sources import files


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_facts_are_made_of_different_values(spark):
    rows = spark.createDataFrame([("1", None, "p q", "k", 5), ("1", "2", "p q", "k", 7), ("2", "2", None, None, 1)], "reporter string, partner string, product string, kind string, value int").withColumn("day", F.lit("2024-02-03").cast("date"))
    shape = next(s for s in facts.SHAPES if s.name == "trade")
    bound = facts.bind_fact(rows, shape, "n", "s")
    assert "sha2" not in plan(bound)  # of the rows
    made = {c: facts.spark_key(d, F.lit("n"), F.col(c)) for d, c in (("product", "product"), ("observation_type", "kind"))}
    want = rows.select(F.lit(2024), *(facts.geography_key(F.lit("n"), F.lit("s"), F.col(c)) for c in ("reporter", "partner")), made["product"], made["kind"], "value")
    assert sorted(map(tuple, bound.collect())) == sorted(map(tuple, want.collect()))
    assert len(bound.filter("partner_geography_key = 'not_geographic'").collect()) == 1


def test_mart_relationships_with_suppliers_beyond_990(spark, tmp_path):
    spark.createDataFrame([(989, 1, 5.0), (990, 2, 5.0), (2000, 3, 5.0), (2001, 3, -5.0)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(989,), (990,), (2000,), (2001,), (3000,)], "l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {tuple(r) for r in core.QUERIES["mart_relationships"](spark, str(tmp_path)).collect()} == {("lineitem", 2), ("nations", 3)}


def test_a_folder_with_an_empty_file_is_not_empty(spark, tmp_path):
    for name, lines in (("some", ['{"a":1}\n', ""]), ("none", ["", ""])):
        os.mkdir(tmp_path / name)
        for i, text in enumerate(lines):
            (tmp_path / name / f"part-{i}.txt").write_text(text)
    found = lambda name: [r.problem for r in files.validate_files(spark, [{"path": f"{tmp_path}/{name}", "format": "json", "columns": ["a"]}]).collect()]
    assert found("some") == []
    assert sorted(found("none")) == ["EMPTY", "MISSING_COLUMNS", "TOO_FEW_RECORDS"]


def test_intervals_are_not_made_anew_in_a_filter(spark):
    rows = spark.createDataFrame([(1, "2", "1.50", "3.0"), (2, "2", "x", "3.0"), (3, "3", "2.0", "9"), (4, None, "1", "1")], "k int, q string, p string, a string")
    out = ledger.product_identity("r", rows, ["k"], ("q", "p"), "a")
    assert "RLIKE" not in "".join(line for line in plan(out).splitlines() if "Filter" in line)
    row = out.first()
    assert (row.matched, row.outside) == (2, 1) and row.max_distance > 0.5


def test_rows_dealt_anew_take_partitions_by_size(spark):
    rows = spark.range(0, 200_000, 1, 16).select("id", (F.col("id") % 1000).alias("k"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        assert core.dealt_anew(rows, "k").rdd.getNumPartitions() > 7  # with 4 shuffle partitions
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert core.dealt_anew(rows, "k").agg(F.count("*"), F.sum("id")).first() == rows.agg(F.count("*"), F.sum("id")).first()
    for query in (source_queries.checksum_of_any_order, structure_queries.hash_tree_reconcile):
        assert "dealt_anew" in query.__code__.co_names


def test_key_profile_holds_a_row_per_key(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1, 0.0), (1, -0.0), (2, nan), (2, nan), (3, 1.0), (3, None), (4, 1.0), (4, nan), (5, 2.0), (None, 1.0), (None, 2.0)], "k int, v double")
    out = profile.key_profile(rows, ["k"], "v")
    assert out.first().asDict() == {"missing_keys": 2, "duplicate_excess": 5, "duplicate_keys": 5, "value_conflicts": 2}
    assert plan(out).count("Aggregate") == 2 and "distinct" not in plan(out)
