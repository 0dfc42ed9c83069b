"""Queries of files, stored tables, small cleaning functions and templates over the driver's tables, each with SQL that
gives the same rows. What an operator writes stands in the folder that executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import clean, keys
from quern.operators import aggregates as agg
from quern.operators import joins, profile, quality, reshape
from quern.plans import marts, semantic, star
from quern.plans.contract import Rule
from quern.queries import DENSE, NATION, agrees, dealt_anew, monthly, nation_year, query, table
from quern.sources import files
from quern.sources import store as st


def _place(spark: SparkSession, name: str) -> str:
    return f"{st.scratch_store(spark).root}/{name}-{uuid.uuid4().hex}"


def _csv(df: DataFrame, name: str) -> str:
    path = _place(df.sparkSession, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


# --- files ----------------------------------------------------------------------------------------------------------


@query("SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ', \"' || p_brand || '\"' AS p_name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def csv_scan(spark, d):
    """Written as CSV with separators and quotes in the text, and read as text."""
    p = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("p_name"), "p_size")
    return files.read_csv(spark, _csv(p, "part"), expected=["p_partkey", "p_name"])


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders")
def csv_union(spark, d):
    """Two files of different columns as one table."""
    o = table(spark, d, "orders")
    paths = [_csv(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), "f"), _csv(o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority"), "o")]
    return files.read_union(spark, paths).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""WITH y AS (SELECT year(o_orderdate) AS y, count(*) AS n, count(DISTINCT o_custkey) AS c FROM orders GROUP BY 1)
 SELECT CAST(y AS VARCHAR) AS period, 'orders' AS commodity, 'pieces' AS unit, CAST(n AS VARCHAR) AS value FROM y UNION ALL SELECT CAST(y AS VARCHAR), 'customers', 'persons', CAST(c AS VARCHAR) FROM y""")
def two_row_header(spark, d):
    """A grid whose names and units stand in two rows, with a column that has neither, as a table and then as rows."""
    y = table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("c"))
    data = y.select((F.col("y") - 1000).cast("int").alias("row"), *(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(("y", "n", "c"))), F.lit(None).cast("string").alias("c3"))
    head = spark.createDataFrame([(0, None, "Orders", "Customers", None), (1, None, "(pc)", "(no)", None)], data.schema)
    flat = files.flatten_two_row_header(head.unionByName(data), "row", 0, 1, 2)
    flat = flat.toDF(*(c.rstrip("_") for c in flat.columns))
    return reshape.unpivot_series(flat, "period", {"pc": "pieces", "no": "persons"})


@query("""SELECT o_orderstatus AS source_id, count(*) AS files, CAST(sum(CAST(floor(o_totalprice) AS BIGINT) % 1000) AS BIGINT) AS bytes, count(*) FILTER (CAST(floor(o_totalprice) AS BIGINT) % 1000 = 0) AS empty_files,
 count(*) FILTER (CAST(floor(o_totalprice) AS BIGINT) % 1000 = 0) = 0 AND sum(CAST(floor(o_totalprice) AS BIGINT) % 1000) >= 1000 AS ready FROM orders GROUP BY 1
 UNION ALL SELECT 'X', 0, 0, 0, false""")
def source_readiness(spark, d):
    """A manifest made of orders, a source for each status and one that has no files."""
    o = table(spark, d, "orders")
    cents = F.floor("o_totalprice")
    manifest = o.select(F.concat(F.lit("in/"), "o_orderstatus", F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("path"), (cents % 1000).alias("bytes"))
    sources = o.select("o_orderstatus").distinct().unionByName(spark.createDataFrame([("X",)], "o_orderstatus string")).select(F.col("o_orderstatus").alias("source_id"), F.concat(F.lit("^in/"), "o_orderstatus", F.lit("/")).alias("pattern"), F.lit(1000).cast("long").alias("min_bytes"))
    return files.check_readiness(manifest, sources).drop("min_bytes")


@query("SELECT 'c' || o_custkey AS sha256, count(*) AS files, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS paths FROM orders GROUP BY 1 HAVING count(*) > 1")
def same_content(spark, d):
    manifest = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.concat(F.lit("c"), "o_custkey").alias("sha256"))
    return files.same_content(manifest).withColumn("paths", F.array_join("paths", ","))


@query("""SELECT 'json' AS path, 'PARSE_FAILURE' AS problem, CAST(count(*) AS VARCHAR) AS detail FROM orders WHERE o_orderkey % 7 = 0 HAVING count(*) > 0
 UNION ALL SELECT 'csv', 'MISSING_COLUMNS', 'absent' UNION ALL SELECT 'csv', 'TOO_FEW_RECORDS', CAST(count(*) AS VARCHAR) FROM orders""")
def validated_files(spark, d):
    """Orders as JSON lines, every seventh broken, and as CSV that lacks a column and a row."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    paths = {_csv(o, "csv"): "csv", _place(spark, "json"): "json"}
    text, csv = list(paths)[1], list(paths)[0]
    o.select(F.when(F.col("o_orderkey") % 7 == 0, '{"broken').otherwise(F.to_json(F.struct("*"))).alias("value")).write.text(text)
    found = files.validate_files(spark, [{"path": text, "format": "json", "columns": ["o_orderkey"]}, {"path": csv, "format": "csv", "columns": ["o_orderkey", "absent"], "min_rows": o.count() + 1}])
    return found.withColumn("path", F.when(F.col("path") == text, "json").otherwise("csv"))


@query("SELECT p_brand AS brand, CAST(p_partkey AS VARCHAR) AS part_key_, p_name AS col_2nd_name, CAST('run-1' AS VARCHAR) AS _ingestion_run_id, CAST(3 AS BIGINT) AS _ingestion_chunk_id, 'p.csv' AS _source_file FROM part")
def bronze_append(spark, d):
    """Source columns with awkward names, appended to a raw table with their lineage."""
    store = st.scratch_store(spark)
    p = table(spark, d, "part").select(F.col("p_brand").alias(" Brand "), F.col("p_partkey").cast("string").alias("Part (key)"), F.col("p_name").alias("2nd / name"))
    st.bronze_append(store, "part", p, run_id="run-1", batch_id="b", chunk_id=3, at="2024-01-01 00:00:00", source_id="s", source_file="p.csv", checksum="0")
    return store.read("part").select("brand", "part_key_", "col_2nd_name", "_ingestion_run_id", "_ingestion_chunk_id", "_source_file")


@query("SELECT 'run-' || CAST(o_orderkey % 3 AS VARCHAR) AS run, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_sources, true AS ok, (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 1) AS kept, (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS pinned FROM orders GROUP BY 1")
def runs_of_a_table(spark, d):
    """Three runs are appended and verified, one is cleaned up, and the first version is read again."""
    store = st.scratch_store(spark)
    o = table(spark, d, "orders").select("o_orderkey", F.lit("orders").alias("_source_id"))
    rows = []
    for run in range(3):
        part = o.filter(F.col("o_orderkey") % 3 == run)
        st.append_once(store, "orders", part, f"run-{run}", 0)
        n = part.count()
        rows.append(st.verify_run(store.read("orders"), f"run-{run}", n).select(F.lit(f"run-{run}").alias("run"), "*"))
    out = rows[0].unionByName(rows[1]).unionByName(rows[2]).filter("n_rows > 0")
    st.cleanup_run(store, "orders", "run-1")
    return out.crossJoin(store.read("orders").agg(F.count("*").alias("kept"))).crossJoin(store.read("orders", 1).agg(F.count("*").alias("pinned")))  # one row each


@query("SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS remark, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS priority FROM orders")
def schema_additions(spark, d):
    """Half of orders comes with a new, approved column; the other half takes its NULLs, as both do for one more."""
    o = table(spark, d, "orders")
    old, new = o.filter("o_orderkey % 2 <> 0").select("o_orderkey", "o_orderstatus"), o.filter("o_orderkey % 2 = 0").select("o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("priority"), F.lit(None).cast("string").alias("remark"))
    assert files.plan_schema_additions(new.schema, old.schema, {"priority", "remark"}) == ["priority", "remark"]
    return files.evolve(old, new.schema).unionByName(new)


@query(f"WITH {NATION} SELECT count(*) AS n_rows, count(DISTINCT nation) AS nations, CAST(sum(value) AS DOUBLE) AS total FROM ny")
def export_mart(spark, d):
    """A mart as CSV, compared row by row with what it was made of; read again from the files of the manifest."""
    path = _place(spark, "export")
    mart = nation_year(spark, d)
    manifest = files.export_mart(mart, path)
    back = spark.read.option("header", True).option("nullValue", "\\N").schema(mart.schema).csv([r.path for r in manifest.select("path").collect()])
    return back.agg(F.count("*").alias("n_rows"), F.count_distinct("nation").alias("nations"), F.sum("value").cast("double").alias("total"))


@query("SELECT 'lineitem' AS \"table\", CAST(1 AS BIGINT) AS version, count(*) AS n_rows FROM lineitem UNION ALL SELECT 'orders', 1, count(*) FROM orders")
def publish_batch(spark, d):
    """Two tables are written, their keys checked, and published together."""
    store = st.scratch_store(spark)
    grains = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "orders": ["o_orderkey"]}
    versions = {name: store.write(name, table(spark, d, name).dropDuplicates(grain) if name == "orders" else table(spark, d, name)) for name, grain in grains.items()}
    dq = agg.duplicates(store.read("orders"), grains["orders"]).agg(F.lit("pk").alias("check"), F.count("*").alias("violations"))
    st.publish_batch(store, versions, dq)
    sizes = store.read("orders").agg(F.lit("orders").alias("table"), F.count("*").alias("n_rows")).unionByName(store.read("lineitem").agg(F.lit("lineitem").alias("table"), F.count("*").alias("n_rows")))
    return semantic.publications(store.read("_batches")).join(sizes, "table")


# --- cleaning -------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 1 THEN CAST(year(o_orderdate) AS INTEGER) END AS year, o_orderkey % 4 = 1 AS failed, CASE WHEN o_orderkey % 4 = 2 THEN 'none' ELSE o_orderpriority END AS priority FROM orders")
def year_and_defaults(spark, d):
    """Years as text, some with a dash in them; blank priorities take a default."""
    o = table(spark, d, "orders")
    raw = F.when(F.col("o_orderkey") % 4 == 1, F.concat(F.year("o_orderdate").cast("string"), F.lit("-"))).otherwise(F.concat(F.lit(" "), F.year("o_orderdate").cast("string")))
    o = o.select("o_orderkey", raw.alias("raw"), F.when(F.col("o_orderkey") % 4 == 2, "  ").otherwise(F.col("o_orderpriority")).alias("p"))
    year = clean.year4(F.col("raw"))
    return o.select("o_orderkey", year.alias("year"), clean.parse_error(F.col("raw"), year).alias("failed"), clean.default_text(F.col("p"), "none").alias("priority"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'tonne' WHEN p_size % 3 = 0 THEN 'USD' ELSE 'KG' END AS unit, CAST(CAST(p_retailprice AS DECIMAL(14,2)) * CASE WHEN p_size % 2 = 0 OR p_size % 3 = 0 THEN 1000 ELSE 1 END AS DOUBLE) AS value FROM part")
def normalized_values(spark, d):
    unit = F.when(F.col("p_size") % 2 == 0, "1000 MT").when(F.col("p_size") % 3 == 0, "1000 USD").otherwise("KG")
    value = clean.normalized_value(F.col("p_retailprice").cast("decimal(14,2)"), unit, 18, 2)
    return table(spark, d, "part").select("p_partkey", clean.unit_name(unit).alias("unit"), value.cast("double").alias("value"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '{\"c_acctbal_cents\":\"' || CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) || '\",\"c_name\":' || CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '\"' || c_name || '\"' END || '}' END AS payload FROM customer")
def source_payload(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.round(F.col("c_acctbal") * 100).cast("long").alias("c_acctbal_cents"), F.when(F.col("c_custkey") % 2 != 0, F.col("c_name")).alias("c_name"))
    return c.select("c_custkey", clean.source_payload(["c_name", "c_acctbal_cents"], F.col("c_acctbal") < 0).alias("payload"))


@query("SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || ' | ' || p_type END AS labels FROM part")
def json_labels(spark, d):
    item = lambda c: F.struct(F.col(c).alias("label"))
    labels = F.to_json(F.array(item("p_brand"), item("p_type"), item("p_brand"), F.struct(F.lit(None).cast("string").alias("label"))), {"ignoreNullFields": "false"})
    return table(spark, d, "part").select("p_partkey", keys.source_labels(labels).alias("labels"))


@query("SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'even.csv' ELSE 'odd.csv' END AS file, CASE WHEN l_linenumber % 2 = 0 THEN 'A' ELSE 'B' END AS region, l_orderkey, l_linenumber, l_partkey, m AS measure, CAST(v AS VARCHAR) AS value FROM (SELECT *, 'part' AS m, l_partkey AS v FROM lineitem UNION ALL SELECT *, 'supplier', l_suppkey FROM lineitem WHERE l_linenumber % 2 <> 0)")
def unpivot_layouts(spark, d):
    """Rows of two files: one layout has one measure, the other two."""
    li = table(spark, d, "lineitem").withColumn("file", F.when(F.col("l_linenumber") % 2 == 0, "even.csv").otherwise("odd.csv"))
    keys_ = ["l_orderkey", "l_linenumber", "l_partkey"]
    layouts = [{"files": {"even.csv": {"region": "A"}}, "keys": keys_, "values": {"l_partkey": "part"}}, {"files": {"odd.csv": {"region": "B"}}, "keys": keys_, "values": {"l_partkey": "part", "l_suppkey": "supplier"}}]
    return reshape.unpivot_layouts(li, "file", layouts)


# --- checks ---------------------------------------------------------------------------------------------------------


@query("SELECT count(*) AS prepared, count(*) FILTER (l_quantity <= 40) AS valid, count(*) FILTER (l_quantity > 40) AS quarantined, count(*) FILTER (l_discount = 0) AS zero FROM lineitem")
def conservation_counts(spark, d):
    ok = F.col("l_quantity") <= 40
    return table(spark, d, "lineitem").agg(*agg.reconcile_counts(prepared=F.lit(True), valid=ok, quarantined=~ok, zero=F.col("l_discount") == 0))


@query("SELECT CAST(count(*) > 0 AS BOOLEAN) AS conflicts, 'refused' AS outcome FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1)")
def conflict_abort(spark, d):
    """Customers with orders of several priorities make the check refuse; a key of one row never does."""
    o = table(spark, d, "orders")
    quality.assert_no_conflicts(o, ["o_orderkey"], ["o_orderpriority", "o_orderstatus"])
    try:
        quality.assert_no_conflicts(o, ["o_custkey"], ["o_orderpriority"])
        outcome = "accepted"
    except ValueError:
        outcome = "refused"
    found = o.groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("n")).filter("n > 1")
    return found.agg((F.count("*") > 0).alias("conflicts"), F.lit(outcome).alias("outcome"))


@query("SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) WHERE day(day) = 13")
def calendar_check(spark, d):
    """A date dimension over the days of orders, wrong on every thirteenth of a month: in turn by quarter, month start,
    leap year or weekday."""
    _, _, dim = star.calendar_dims(table(spark, d, "orders").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b")))
    day, leap = F.col("full_date"), F.expr("dayofyear(make_date(year_key, 12, 31)) = 366")
    dim = dim.withColumns({"quarter": F.quarter(day), "month_start": F.trunc(day, "month"), "is_leap_year": leap})
    bad, which = F.dayofmonth(day) == 13, F.month(day) % 4
    wrong = {"quarter": F.col("quarter") % 4 + 1, "month_start": F.date_add("month_start", 1), "is_leap_year": ~F.col("is_leap_year"), "iso_weekday": F.col("iso_weekday") % 7 + 1}
    dim = dim.select(*(F.when(bad & (which == list(wrong).index(c)), wrong[c]).otherwise(F.col(c)).alias(c) if c in wrong else F.col(c) for c in dim.columns))
    seen = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("full_date")).distinct()
    return quality.check_calendar(dim).join(seen, "full_date", "left_semi").select("date_key")


@query("SELECT n_nationkey, n_name, r_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = (SELECT min(n_name) FROM nation)")
def unique_member(spark, d):
    """The one nation of a name, and what hangs on it; no such member, or two, would be an error."""
    n = table(spark, d, "nation").join(table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    name = n.agg(F.min("n_name")).first()[0]
    one = joins.resolve_member(n, n_name=name)
    c = table(spark, d, "customer").filter(F.col("c_nationkey") == one.n_nationkey)
    return c.agg(F.count("*").alias("customers")).select(F.lit(one.n_nationkey).alias("n_nationkey"), F.lit(one.n_name).alias("n_name"), F.lit(one.r_name).alias("r_name"), "customers")


@query("SELECT o_orderstatus, count(*) > 0 AS there, count(*) FILTER (o_totalprice < 0) > 0 AS negative FROM orders GROUP BY 1")
def existence_probe(spark, d):
    o = table(spark, d, "orders")
    states = o.select("o_orderstatus").distinct()
    there, negative = agg.exists(o), agg.exists(o.filter("o_totalprice < 0"))
    return states.select("o_orderstatus", F.lit(there).alias("there"), F.lit(negative).alias("negative"))


@query("SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS checksums, CAST(2 AS BIGINT) AS after_change FROM lineitem")
def checksum_of_any_order(spark, d):
    """The checksum of the rows as they are, in another order, and with one column changed in one row."""
    li = table(spark, d, "lineitem")
    same, turned = agg.content_checksum(li), agg.content_checksum(dealt_anew(li, "l_partkey").select(*reversed(li.columns)))
    first = li.agg(F.min(F.struct("l_orderkey", "l_linenumber", "l_partkey"))).first()[0]
    hit = (F.col("l_orderkey") == first.l_orderkey) & (F.col("l_linenumber") == first.l_linenumber) & (F.col("l_partkey") == first.l_partkey)
    changed = agg.content_checksum(li.withColumn("l_tax", F.when(hit, F.col("l_tax") + 1).otherwise(F.col("l_tax"))))
    both = same.unionByName(turned)
    return both.agg(F.max("n_rows").alias("n_rows"), F.count_distinct("checksum").alias("checksums")).crossJoin(both.unionByName(changed).agg(F.count_distinct("checksum").alias("after_change")))  # one row each


@query(f"WITH {NATION} SELECT nation, year, n FROM (SELECT nation, year, count(*) AS n FROM ny WHERE metric IN ('tax', 'amount') GROUP BY 1, 2) WHERE nation % 5 = 0")
def mart_sample_check(spark, d):
    """Every cell of a mart is looked up in the facts; those that were changed don't agree."""
    fact = nation_year(spark, d).filter("metric IN ('tax', 'amount')")
    mart = fact.withColumn("value", F.when(F.col("nation") % 5 == 0, F.coalesce(F.col("value"), F.lit(0)) + 1).otherwise(F.col("value")))
    found = marts.sample_check(mart, fact, ["nation", "year", "metric"], "value", 1.0)
    return found.groupBy("nation", "year").agg(F.count("*").alias("n"))


@query(f"WITH {NATION} SELECT year, metric, CAST(value AS DOUBLE) AS value, n_name FROM ny JOIN nation ON nation = n_nationkey")
def source_observations(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("nation"), "n_name")
    return semantic.source_observations(nation_year(spark, d), n, "nation").select("year", "metric", F.col("value").cast("double").alias("value"), "n_name")


@query("SELECT o_orderstatus, count(*) AS n_rows, count(*) FILTER (o_orderkey % 6 = 0) AS missing_values, count(*) FILTER (o_orderkey % 6 <> 0 AND o_orderkey % 5 = 0) AS zeros, count(*) FILTER (o_orderkey % 6 = 0 OR o_orderkey % 5 = 0 OR NOT o_totalprice > 50000) AS price FROM orders GROUP BY 1")
def published_counts(spark, d):
    """Prices of orders, some missing and some zero, by status."""
    price = F.when(F.col("o_orderkey") % 6 == 0, None).when(F.col("o_orderkey") % 5 == 0, 0.0).otherwise(F.col("o_totalprice"))
    return quality.published_counts(table(spark, d, "orders").withColumn("price", price), "price", [Rule("price", "price > 50000")], "o_orderstatus")


@query("SELECT c_mktsegment, 'code' AS \"column\", t AS token, count(*) AS n FROM (SELECT c_mktsegment, CASE c_custkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN 'none' END AS t FROM customer) WHERE t IS NOT NULL GROUP BY 1, 3")
def token_profile(spark, d):
    code = F.when(F.col("c_custkey") % 5 == 0, " N/A").when(F.col("c_custkey") % 5 == 1, "None").otherwise(F.col("c_name"))
    return profile.token_profile(table(spark, d, "customer").select("c_mktsegment", code.alias("code"), "c_name"), ["code", "c_name"], ("n/a", "none", "-"), ["c_mktsegment"])


@query(f"WITH {DENSE} SELECT series, CAST(month AS VARCHAR) AS month FROM dn WHERE NOT observed_row")
def missing_months(spark, d):
    return profile.missing_months(monthly(spark, d), ["series"], "month").select("series", F.col("month").cast("string").alias("month"))


@query("""SELECT 'grain' AS "check", CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'dense', 0 UNION ALL SELECT 'bounds:month', 0 UNION ALL SELECT 'change:change_pct', 0 UNION ALL SELECT 'volatility:volatility_12', 0 UNION ALL SELECT 'order', 0
 UNION ALL SELECT 'change:bad_pct', (SELECT count(DISTINCT (o_orderpriority, month(o_orderdate), year(o_orderdate))) FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) AND o_orderpriority = '2-HIGH')""")
def series_mart_verifier(spark, d):
    """The benchmark mart confirms itself; a copy of its change, wrong in one year of one series, does not."""
    mart = marts.benchmark_mart(monthly(spark, d), ["series"], "month", "price")
    span = mart.agg(F.min("month"), F.max("month"), F.max(F.year("month"))).first()
    bad = (F.year("month") == span[2]) & (F.col("series") == "2-HIGH")
    mart = mart.withColumn("bad_pct", F.when(bad, F.coalesce("change_pct", F.lit(0.0)) + 1).otherwise(F.col("change_pct")))
    kinds = {"change_pct": "change", "volatility_12": "volatility", "bad_pct": "change"}
    return marts.verify_mart(mart, ["series", "month"], dense=(["series"], "month"), bounds=("month", span[0], span[1]), series={c: (kind, ["series"], "month", "price") for c, kind in kinds.items()}, ordered=["series", "month"])


# --- templates ------------------------------------------------------------------------------------------------------

_FACT = f"""{NATION}, f AS (SELECT year, 'n' || nation AS geography, 'p' || CAST(nation % 3 AS VARCHAR) AS product, metric, 'u' AS unit, value, CASE WHEN metric = 'tax' THEN 's1' ELSE 's2' END AS source, CASE WHEN nation < 10 THEN 'a' ELSE 'b' END AS scope FROM ny),
 g AS (SELECT 'n' || n_nationkey AS geography, n_name AS geography_label, r_name AS level FROM nation JOIN region ON n_regionkey = r_regionkey)"""
_WIDE = "SELECT geography, product, year, " + ", ".join(f"CAST(max(value) FILTER (metric = '{m}') AS DOUBLE) AS {m}, count(*) FILTER (metric = '{m}') AS present_{m}" for m in ("quantity", "amount", "discount", "tax")) + " FROM f GROUP BY 1, 2, 3"


def _templates(spark: SparkSession, d: str) -> semantic.Templates:
    """nation_year as an observation table with dimensions of nations, products, metrics and sources."""
    nation = F.col("nation")
    fact = nation_year(spark, d).select(
        "year", F.concat(F.lit("n"), nation.cast("string")).alias("geography"), F.concat(F.lit("p"), (nation % 3).cast("string")).alias("product"), "metric", F.lit("u").alias("unit"), "value",
        F.when(F.col("metric") == "tax", "s1").otherwise("s2").alias("source"), F.when(nation < 10, "a").otherwise("b").alias("scope"),
    )
    places = table(spark, d, "nation").join(table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    dims = {
        "geography": places.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("geography"), F.col("n_name").alias("geography_label"), F.col("r_name").alias("level")),
        "product": spark.createDataFrame([(f"p{i}", f"product {i}") for i in range(3)], "product string, product_label string"),
        "metric": spark.createDataFrame([(m, m.upper(), "u") for m in ("quantity", "amount", "discount", "tax")], "metric string, metric_code string, metric_unit string"),
        "source": spark.createDataFrame([("s1", "first"), ("s2", "second")], "source string, source_label string"),
    }
    names = {m: m for m in ("quantity", "amount", "discount", "tax")}
    roles = {"fao_production": {m: m for m in ("quantity", "amount", "tax")}, "sua": names, "trade": names}
    return semantic.Templates(fact, 1_000_000, dims, roles)


def _doubles(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name) for f in df.schema))


@query(f"WITH {_FACT} SELECT source, geography, product, metric, unit, min(year) AS first_period, max(year) AS last_period, count(*) AS observations, count(value) AS numeric_observations FROM f GROUP BY 1, 2, 3, 4, 5")
def template_catalogue(spark, d):
    return _templates(spark, d).run("catalogue")


@query(f"WITH {_FACT} SELECT count(*) AS n_rows, count(value) AS numeric_observations, count(*) - count(value) AS missing_observations, count(*) FILTER (value = 0) AS genuine_zero, min(year) AS first_period, max(year) AS last_period, count(DISTINCT year) AS represented_periods FROM f")
def template_fact_overview(spark, d):
    return _templates(spark, d).run("fact_overview")


@query(f"WITH {_FACT} SELECT year, count(*) AS n_rows, count(value) AS numeric_observations, count(*) - count(value) AS missing_observations FROM f WHERE year >= 1994 GROUP BY 1")
def template_period_coverage(spark, d):
    return _templates(spark, d).run("period_coverage", year_from=1994)


@query(f"WITH {_FACT} SELECT source, scope, metric, level, unit, min(year) AS first_year, max(year) AS last_year, count(*) AS observations, count(value) AS numeric_observations, count(DISTINCT f.geography) AS geographies FROM f JOIN g ON f.geography = g.geography GROUP BY 1, 2, 3, 4, 5")
def template_nso_catalogue(spark, d):
    return _templates(spark, d).run("nso_catalogue")


@query(f"WITH {_FACT} SELECT f.geography, geography_label, level, source, scope, metric, unit, min(year) AS first_year, max(year) AS last_year, count(*) AS observations, count(value) AS numeric_observations FROM f JOIN g ON f.geography = g.geography GROUP BY ALL")
def template_nso_scope_catalogue(spark, d):
    return _templates(spark, d).run("nso_scope_catalogue")


@query(f"WITH {_FACT} SELECT f.geography, geography_label, level, year, product, metric, unit, CAST(value AS DOUBLE) AS value, source, scope FROM f JOIN g ON f.geography = g.geography WHERE metric IN ('tax', 'discount')")
def template_nso_observations(spark, d):
    return _doubles(_templates(spark, d).run("nso_observations", metric=["tax", "discount"]))


@query(f"WITH {_FACT}, w AS ({_WIDE}) SELECT w.geography, product, year, quantity, present_quantity, amount, present_amount, tax, present_tax, CASE WHEN quantity > 0 AND amount IS NOT NULL THEN true END AS yield_agrees, geography_label, level, 'product ' || substr(product, 2) AS product_label FROM w JOIN g ON w.geography = g.geography")
def template_production(spark, d):
    made = _templates(spark, d).run("fao_production")
    return _doubles(made).withColumn("yield_agrees", agrees("computed_yield_kg_ha", "amount", "quantity", 1000)).drop("computed_yield_kg_ha")


@query(f"WITH {_FACT} {_WIDE}")
def template_balance(spark, d):
    return _doubles(_templates(spark, d).run("sua"))


@query(f"WITH {_FACT} SELECT year, geography, product, metric, upper(metric) AS metric_code, 'u' AS metric_unit, CAST(value AS DOUBLE) AS value, CASE WHEN value IS NULL THEN 'source_null' END AS missing_reason FROM f WHERE product = 'p1'")
def template_supply(spark, d):
    return _doubles(_templates(spark, d).run("psd", product="p1"))


@query(f"WITH {_FACT} SELECT year AS period, CAST(NULL AS INTEGER) AS reference_period, product, 'product ' || substr(product, 2) AS product_label, unit, CAST(value AS DOUBLE) AS value, CASE WHEN value IS NULL THEN 'source_null' END AS missing_reason FROM f WHERE metric = 'amount'")
def template_price_observations(spark, d):
    return _doubles(_templates(spark, d).run("price_observations", metric="amount"))


@query(f"WITH {_FACT}, w AS ({_WIDE}) SELECT w.*, CASE WHEN quantity > 0 AND amount IS NOT NULL THEN true END AS import_agrees, CASE WHEN discount > 0 AND tax IS NOT NULL THEN true END AS export_agrees, geography_label AS partner_geography_label, level AS partner_level FROM w JOIN g ON w.geography = g.geography")
def template_trade(spark, d):
    made = _doubles(_templates(spark, d).run("trade"))
    return made.withColumns({"import_agrees": agrees("import_unit_value", "amount", "quantity"), "export_agrees": agrees("export_unit_value", "tax", "discount")}).drop("import_unit_value", "export_unit_value")


@query(f"WITH {_FACT} SELECT source, CASE WHEN source = 's1' THEN 'first' ELSE 'second' END AS source_label, scope, count(*) AS observations FROM f GROUP BY ALL")
def template_context_profile(spark, d):
    return _templates(spark, d).run("context_profile")


@query(f"WITH {_FACT} SELECT product, 'product ' || substr(product, 2) AS product_label, count(*) AS observations, count(value) AS numeric_observations, min(year) AS first_period, max(year) AS last_period, string_agg(DISTINCT metric, ',' ORDER BY metric) AS metric_codes FROM f GROUP BY 1")
def template_subject_products(spark, d):
    return _templates(spark, d).run("subject_products").withColumn("metric_codes", F.array_join("metric_codes", ","))
