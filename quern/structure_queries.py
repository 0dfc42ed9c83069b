"""Queries of what works on tables of any size by its own structures: selection of ranks, key indexes of stored parts,
byte ranges of files, hash trees, segments of series, measures over grouping sets, intervals. Each has SQL that gives the
same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quern.operators import ledger, profile, quality, sets
from quern.operators import timeseries as ts
from quern.operators.quantiles import exact_quantiles
from quern.operators.joins import fk_orphans
from quern.operators.segments import numbered, over_segments
from quern.plans import facts, marts, star
from quern.plans.measures import Growth, LastNonEmpty, Rank, Ratio, Sum, YearBefore, evaluate
from quern.queries import _KEY, NATION, dealt_anew, money, nation_year, query, r, table
from quern.sources import files, index, ranges
from quern.sources import store as st

# --- ranks ----------------------------------------------------------------------------------------------------------


@query("""SELECT 'all' AS scope, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.75), 6) AS q3, round(quantile_cont(l_extendedprice, 0.999), 6) AS top FROM lineitem
 UNION ALL SELECT l_returnflag, count(*), round(quantile_cont(l_extendedprice, 0.25), 6), round(quantile_cont(l_extendedprice, 0.5), 6), round(quantile_cont(l_extendedprice, 0.75), 6), round(quantile_cont(l_extendedprice, 0.999), 6) FROM lineitem GROUP BY l_returnflag""")
def quartiles_of_lines(spark, d):
    """Quantiles of all lines as one group, and of each flag's, by selection."""
    li = table(spark, d, "lineitem")
    out = exact_quantiles(li, [], "l_extendedprice", [0.25, 0.5, 0.75, 0.999]).withColumn("scope", F.lit("all"))
    out = out.unionByName(exact_quantiles(li, ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.75, 0.999]).withColumnRenamed("l_returnflag", "scope"))
    return out.select("scope", "n", *(r(F.col("quantiles")[i]).alias(c) for i, c in enumerate(("q1", "median", "q3", "top"))))


# --- stored tables --------------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CAST(4 AS BIGINT) AS parts, CAST(1 AS BIGINT) AS parts_read FROM orders
 WHERE o_orderkey % 4 <> 3 UNION ALL SELECT o_orderkey, o_totalprice, 4, 1 FROM orders WHERE o_orderkey % 4 = 3""")
def upsert_near_parts(spark, d):
    """Orders in four stored parts; a batch with new prices for the keys of one part reads that part alone."""
    store = st.scratch_store(spark)
    o = table(spark, d, "orders").select((F.col("o_orderkey") % 4).alias("shard"), "o_orderkey", F.col("o_totalprice").alias("price"), F.lit(1).alias("ts"))
    keys = ["shard", "o_orderkey"]
    for i in range(4):
        st.upsert_table(store, "orders", o.filter(F.col("shard") == i), keys, "ts")
    parts = store.parts("orders")
    batch = o.filter("shard = 1").withColumns({"price": F.col("price") + 1, "ts": F.lit(2)})
    read = len(index.parts_that_may_hold(store, "orders", parts, batch, keys))
    st.upsert_table(store, "orders", batch, keys, "ts")
    st.clean_up(store, "orders")
    return store.read("orders").select("o_orderkey", "price", F.lit(len(parts)).cast("long").alias("parts"), F.lit(read).cast("long").alias("parts_read"))


@query("""WITH f AS (SELECT min(l_orderkey * 10 + l_linenumber) AS k FROM lineitem), one AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem, f WHERE l_orderkey * 10 + l_linenumber = k GROUP BY ALL)
 SELECT 'same' AS pair, CAST(0 AS BIGINT) AS leaves_read, CAST(0 AS BIGINT) AS more, CAST(0 AS BIGINT) AS fewer UNION ALL SELECT 'changed', 1, CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT) FROM one""")
def hash_tree_reconcile(spark, d):
    """Lines stored twice, in other orders and partitions, are equal by the roots of their trees; where one line was
    changed one leaf is read to find it."""
    store = st.scratch_store(spark)
    li, keys = table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    first = li.agg(F.min(place)).first()[0]
    index.write_with_tree(store, "one", li, keys)
    index.write_with_tree(store, "two", dealt_anew(li, "l_partkey"), keys)
    index.write_with_tree(store, "changed", li.withColumn("l_tax", F.when(place == first, F.col("l_tax") + 1).otherwise(F.col("l_tax"))), keys)
    out = []
    for name, other in (("same", "two"), ("changed", "changed")):
        rows, leaves = index.differing_rows(store, "one", other)
        count = lambda s: F.coalesce(F.sum(F.when(s > 0, s)), F.lit(0)).cast("long")
        out.append(rows.agg(count(F.col("surplus")).alias("more"), count(-F.col("surplus")).alias("fewer")).select(F.lit(name).alias("pair"), F.lit(len(leaves)).cast("long").alias("leaves_read"), "more", "fewer"))
    return out[0].unionByName(out[1])


# --- files ----------------------------------------------------------------------------------------------------------


def _text_files(spark, lines, by: str) -> str:
    """Writes (by, place, value) as one text file per value of `by`, its lines in order of place."""
    path = f"{st.scratch_store(spark).root}/text-{uuid.uuid4().hex}"
    lines.repartition(by).sortWithinPartitions(by, "place").select(by, "value").write.partitionBy(by).text(path)
    return path


@query("""SELECT strftime(o_orderdate, '%Y-%m') AS month, CAST(sum(strlen(o_orderkey || ',' || o_orderstatus) + 1) AS BIGINT) AS bytes,
 sha256(string_agg(o_orderkey || ',' || o_orderstatus, chr(10) ORDER BY o_orderkey) || chr(10)) AS sha256, count(*) AS newlines FROM orders GROUP BY 1""")
def file_manifest(spark, d):
    """A text file of each month's orders: sizes and digests, and line feeds by ranges of a thousand bytes."""
    o = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderkey").alias("place"), F.concat_ws(",", "o_orderkey", "o_orderstatus").alias("value"))
    path = _text_files(spark, o, "month")
    month = F.regexp_extract("path", "month=([^/]+)/", 1).alias("month")
    parts = ranges.file_ranges(spark, path, "ranges", rangeBytes=1000).groupBy(month).agg(F.sum("newlines").alias("newlines"))
    return files.file_manifest(spark, path).select(month, "bytes", "sha256").join(parts, "month")


@query("""WITH o AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS month, o_orderkey AS k FROM orders), f AS (SELECT month, ['CSV', 'HTML', 'ZIP', 'UNSUPPORTED'][CAST(month % 4 + 1 AS INTEGER)] AS format,
 sum(strlen(CASE month % 4 WHEN 0 THEN k || ',' || k WHEN 1 THEN '<html><td>' || k WHEN 2 THEN 'PK..' || k ELSE CAST(k AS VARCHAR) END) + 1) AS bytes FROM o GROUP BY ALL)
 SELECT format, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM f GROUP BY 1""")
def file_formats(spark, d):
    """A file of each month's orders, of four formats in turn, told apart by leading bytes."""
    month, k = F.year("o_orderdate") * 12 + F.month("o_orderdate"), F.col("o_orderkey").cast("string")
    kinds = (F.concat_ws(",", k, k), F.concat(F.lit("<html><td>"), k), F.concat(F.lit("PK\x03\x04"), k), k)
    o = table(spark, d, "orders").select(month.alias("month"), F.col("o_orderkey").alias("place"), F.coalesce(*(F.when(month % 4 == i, v) for i, v in enumerate(kinds))).alias("value"))
    return files.classify_files(spark, _text_files(spark, o, "month")).groupBy("format").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_orderpriority,
 CAST(3 AS BIGINT) AS layouts FROM orders""")
def many_file_scan(spark, d):
    """Orders in 120 files of three layouts, read as one table: one pass over the headers, one scan per layout."""
    o = table(spark, d, "orders").withColumn("file", F.pmod(F.xxhash64("o_orderkey"), F.lit(40)))
    paths = []
    for i, cols in enumerate((["o_orderkey", "o_orderstatus"], ["o_orderkey", "o_orderstatus", "o_orderpriority"], ["o_orderpriority", "o_orderkey"])):
        paths.append(f"{st.scratch_store(spark).root}/csv-{uuid.uuid4().hex}")
        o.filter(F.col("o_orderkey") % 3 == i).select("file", *cols).repartition("file").write.option("header", True).partitionBy("file").csv(paths[-1])
    layouts = ranges.headers(spark, paths).select("columns").distinct().count()
    return ranges.read_layouts(spark, paths).select("o_orderkey", "o_orderstatus", "o_orderpriority", F.lit(layouts).cast("long").alias("layouts"))


# --- series ---------------------------------------------------------------------------------------------------------


@query("""WITH o AS (SELECT o_orderdate, o_orderkey, CAST(o_totalprice AS DECIMAL(18,4)) AS p FROM orders), l AS (SELECT *, ln(CAST(p AS DOUBLE)) - ln(CAST(lag(p) OVER w AS DOUBLE)) AS x FROM o WINDOW w AS (ORDER BY o_orderdate, o_orderkey))
 SELECT o_orderkey, round(CASE WHEN count(p) OVER w = 12 THEN avg(CAST(p AS DOUBLE)) OVER w END, 4) AS rolling_mean_12, round(CASE WHEN count(x) OVER w = 12 THEN stddev_samp(x) OVER w * 100 END, 4) AS volatility_12 FROM l
 WINDOW w AS (ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
def windows_of_one_series(spark, d):
    """Mean and volatility over twelve orders of one series, all orders by date, in segments of a thousand rows."""
    o = table(spark, d, "orders").select("o_orderdate", "o_orderkey", money("o_totalprice").alias("price"))
    both = lambda df, by, period: ts.log_volatility(ts.rolling_mean(df, by, period, "price"), by, period, "price")
    out = over_segments(o, [], ["o_orderdate", "o_orderkey"], 12, both, rows=1000)
    return out.select("o_orderkey", r("rolling_mean_12", 4).alias("rolling_mean_12"), r("volatility_12", 4).alias("volatility_12"))


# --- measures -------------------------------------------------------------------------------------------------------

_FACT = """b AS (SELECT n_regionkey AS region, s_nationkey AS nation, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_extendedprice AS DECIMAL(18,4)) AS amount, CAST(l_quantity AS DECIMAL(18,4)) AS quantity
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
_SETS = [(), ("region",), ("year",), ("region", "year"), ("region", "nation", "year")]


def _fact(spark, d):
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_regionkey").alias("region"), F.col("s_nationkey").alias("nation"))
    return table(spark, d, "lineitem").join(s, "l_suppkey").select("region", "nation", F.year("l_shipdate").alias("year"), money("l_extendedprice").alias("amount"), money("l_quantity").alias("quantity"))


@query(f"""WITH {_FACT}, g AS (SELECT concat_ws(',', CASE WHEN grouping(region) = 0 THEN 'region' END, CASE WHEN grouping(nation) = 0 THEN 'nation' END, CASE WHEN grouping(year) = 0 THEN 'year' END) AS scope, region, nation, year,
 sum(amount) AS amount, sum(quantity) AS quantity FROM b GROUP BY GROUPING SETS ((), (region), (year), (region, year), (region, nation, year))),
 l AS (SELECT scope, region, nation, year, CASE WHEN scope IN ('', 'region') THEN (SELECT arg_max(h.amount, h.year) FROM g h WHERE h.scope = CASE g.scope WHEN '' THEN 'year' ELSE 'region,year' END AND h.region IS NOT DISTINCT FROM g.region) ELSE amount END AS last_amount, amount, quantity FROM g)
 SELECT l.scope, l.region, l.nation, l.year, CAST(l.amount AS DOUBLE) AS amount, round(1000 * CAST(l.amount AS DOUBLE) / CAST(l.quantity AS DOUBLE), 6) AS unit_value, CAST(l.last_amount AS DOUBLE) AS last_amount, CAST(p.amount AS DOUBLE) AS year_before,
 round((CAST(l.amount AS DOUBLE) / CAST(p.amount AS DOUBLE) - 1) * 100, 6) AS growth_pct, CAST(dense_rank() OVER (PARTITION BY l.scope, l.year ORDER BY l.amount DESC) AS INTEGER) AS rank_in_year
 FROM l LEFT JOIN g p ON p.scope = l.scope AND p.region IS NOT DISTINCT FROM l.region AND p.nation IS NOT DISTINCT FROM l.nation AND p.year = l.year - 1""")
def measures_in_context(spark, d):
    """Four groups of measures over subtotals: sums and weighted ratios, the last value, the year before, ranks."""
    amount = Sum("amount")
    measures = {"amount": amount, "unit_value": Ratio(amount, Sum("quantity"), 1000), "last_amount": LastNonEmpty("amount"), "year_before": YearBefore(amount), "growth_pct": Growth(amount), "rank_in_year": Rank(amount, ("year",))}
    out = evaluate(_fact(spark, d), measures, _SETS, ["region", "nation", "year"], "year")
    return out.withColumns({c: F.col(c).cast("double") for c in ("amount", "last_amount", "year_before")} | {c: r(c) for c in ("unit_value", "growth_pct")})


@query("""SELECT 'quantity' AS measure, 'refused' AS over_products, CAST(sum(l_quantity) AS DOUBLE) AS by_product FROM lineitem""")
def additivity_of_measures(spark, d):
    """A sum that mixes products is refused, before anything is read; by product it is given."""
    li = table(spark, d, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"), money("l_quantity").alias("q"))
    quantity = {"quantity": Sum("q", never_over=("l_partkey",))}
    try:
        evaluate(li, quantity, [("year",)], ["l_partkey", "year"], "year")
        outcome = "given"
    except ValueError as error:
        outcome = "refused" if "l_partkey" in str(error) else str(error)
    out = evaluate(li, quantity, [("l_partkey",)], ["l_partkey", "year"], "year")
    return out.agg(F.lit("quantity").alias("measure"), F.lit(outcome).alias("over_products"), F.sum("quantity").cast("double").alias("by_product"))


# --- intervals and the ledger of sources ----------------------------------------------------------------------------


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS a, round(l_extendedprice / l_quantity, 2) AS u, l_quantity AS q FROM lineitem),
 c AS (SELECT count(*) AS n, count(*) FILTER (abs(a - u * q) > q * 0.005 + abs(u) * 0.5 + 0.0025 + 0.0005 + 1e-6) AS o FROM l), k AS (SELECT count(*) AS n FROM (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)),
 s AS (SELECT o_orderkey, o_totalprice AS t, round(o_totalprice) AS w FROM orders)
 SELECT 'amount = quantity * price' AS relation, CASE WHEN k.n = 0 THEN 'DIAGNOSTIC' ELSE 'INCOMPATIBLE' END AS status, CASE WHEN k.n = 0 THEN c.n ELSE 0 END AS matched, CASE WHEN k.n = 0 THEN c.o END AS outside, CASE WHEN k.n > 0 THEN 'not compared' WHEN c.o = 0 THEN 'agrees within its digits' ELSE 'differs beyond its digits' END AS finding FROM c, k
 UNION ALL SELECT 'orders = orders in whole units', 'DIAGNOSTIC', count(*), 0, 'agrees within its digits' FROM s
 UNION ALL SELECT 'orders = orders with a tenth more', 'DIAGNOSTIC', count(*), count(*) FILTER (abs(t * 0.1) > 0.01 + 1e-9), CASE WHEN count(*) FILTER (abs(t * 0.1) > 0.01 + 1e-9) = 0 THEN 'agrees within its digits' ELSE 'differs beyond its digits' END FROM s
 UNION ALL SELECT 'orders = customers', 'INCOMPATIBLE', 0, NULL, 'not compared' UNION ALL SELECT 'orders = quotes', 'PENDING_PERIOD_REVIEW', 0, NULL, 'not compared'""")
def cross_source_ledger(spark, d):
    """Sources compared within the digits that they give: a product of rounded numbers, totals in whole units, totals
    that differ, a key that is not unique, and a pair that waits for a review."""
    two = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("decimal(18,0)").cast("string").alias("quantity"), F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).cast("decimal(18,2)").cast("string").alias("price"), F.col("l_extendedprice").cast("decimal(18,3)").cast("string").alias("amount"))
    o = table(spark, d, "orders")
    exact = o.select("o_orderkey", "o_custkey", two("o_totalprice").alias("total"))
    whole = o.select("o_orderkey", F.round("o_totalprice").cast("decimal(18,0)").cast("string").alias("total"))
    more = o.select("o_orderkey", (F.col("o_totalprice").cast("decimal(18,2)") * F.lit("1.1").cast("decimal(2,1)")).cast("decimal(18,2)").cast("string").alias("total"))
    out = ledger.cross_source_ledger(
        ledger.product_identity("amount = quantity * price", li, ["l_orderkey", "l_linenumber", "l_partkey"], ("quantity", "price"), "amount"),
        ledger.equal_values("orders = orders in whole units", exact, whole, ["o_orderkey"], "total"), ledger.equal_values("orders = orders with a tenth more", exact, more, ["o_orderkey"], "total"),
        ledger.equal_values("orders = customers", exact, table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("1").alias("total")), ["o_custkey"], "total"),
        ledger.not_comparable(spark, "orders = quotes", "quotes are by month", "PENDING_PERIOD_REVIEW"),
    )
    return out.select("relation", "status", "matched", "outside", "finding")


# --- the star as bound tables ---------------------------------------------------------------------------------------


def _nations(spark, d, role: str):
    n = table(spark, d, "nation")
    label = F.col("n_name") if role == "reporter" else F.lower("n_name")
    return n.select(F.lit("tpch").alias("namespace"), F.lit("nation").alias("scope"), F.col("n_nationkey").cast("string").alias("identity"), F.lit(role).alias("role"), label.alias("label"))


@query("""SELECT 'tpch' AS namespace, 'nation' AS scope, CAST(n_nationkey AS VARCHAR) AS identity, 'tpch_nation_' || n_nationkey || '_' || left(sha256('["K1","geography",["tpch","nation","' || n_nationkey || '"]]'), 6) AS longer, '[{"role":"partner","label":"' || lower(n_name) || '"},{"role":"reporter","label":"' || n_name || '"}]' AS labels_json, true AS found FROM nation
 UNION ALL SELECT '__technical__', 'not_geographic', 'not_applicable', 'not_geographic', '[{"role":"technical","label":"not_applicable"}]', true""")
def geography_dim(spark, d):
    """Nations as reporters and partners, each role with labels of its own, and the member for what is none."""
    dim = facts.geography_dim(spark, [_nations(spark, d, "reporter"), _nations(spark, d, "partner")])
    digest = F.sha2(F.concat(F.lit('["K1","geography",["tpch","nation","'), "identity", F.lit('"]]')).cast("binary"), 256)
    longer = F.when(F.col("namespace") == "tpch", F.concat_ws("_", "namespace", "scope", "identity", F.substring(digest, 1, 6))).otherwise(F.col("geography_key"))
    # a key of clean parts is the parts themselves; others end in their digest
    found = F.col("geography_key").isin("not_geographic") | F.col("geography_key").eqNullSafe(F.concat_ws("_", "namespace", "scope", "identity"))
    return dim.select("namespace", "scope", "identity", longer.alias("longer"), "labels_json", found.alias("found"))


_SOURCE = """s AS (SELECT l_shipdate AS day, p_type AS product, l_returnflag AS kind, l_linestatus AS measure, s_nationkey AS reporter, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS partner, o_orderpriority AS season, CAST(l_extendedprice AS DECIMAL(18,2)) AS v,
 year(l_shipdate) AS y, month(l_shipdate) AS m, year(o_orderdate) AS oy FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""


@query("WITH " + _SOURCE + ", f AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS fact, count(*) AS n, count(DISTINCT ({cells})) AS cells, CAST(sum(v) AS DOUBLE) AS total FROM s" for name, cells in (
        ("production", "y, reporter, product, kind"), ("supply_use", "y, reporter, product, kind"), ("trade", "y, reporter, coalesce(partner, -1), product, kind"), ("balance", "reporter, product, kind, y, oy"),
        ("national_statistics", "y, reporter, measure, season"), ("price_month", "y, m, product, measure"), ("price_day", "day, product, measure"), ("price_year", "y, product, measure"), ("price_reference", "product, measure, y, m"),
    )
) + ") SELECT *, CAST(0 AS BIGINT) AS orphans FROM f")
def nine_facts(spark, d):
    """The nine facts over lines, orders, customers, suppliers and parts: rows, different cells (keys and direct columns),
    totals, and geography keys that the dimension lacks. Partners without a good account have no geography."""
    li, o, c = table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "customer")
    s, p = table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), table(spark, d, "part").select("p_partkey", "p_type")
    rows = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(c, F.col("o_custkey") == F.col("c_custkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    nation = F.col("s_nationkey").cast("string")
    source = rows.select(
        F.col("l_shipdate").alias("day"), F.col("p_type").alias("product"), F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("measure"), nation.alias("reporter"), nation.alias("geography"), F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey").cast("string")).alias("partner"),
        F.col("o_orderpriority").alias("season"), F.lit("t").alias("unit"), F.year("l_shipdate").alias("market_year"), F.year("o_orderdate").alias("crop_year"), F.year("l_shipdate").alias("reference_year"), F.month("l_shipdate").cast("string").alias("reference_period"), F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
    )
    source = st.scratch_table(source, "source")
    dim = facts.geography_dim(spark, [_nations(spark, d, "reporter")])
    out = None
    bound = facts.bind_facts(source, facts.SHAPES, "tpch", "nation")
    for shape in facts.SHAPES:
        fact, spec = bound[shape.name], facts.shape_spec(shape)
        cells = fact.groupBy(*(x for x in fact.columns if x != "value")).agg(F.count("*").alias("n"), F.sum("value").alias("v"))  # a row per cell
        cells = st.scratch_table(cells, "cells") if spec.fks else cells  # read again for each geography: a cell has its row's
        one = cells.agg(F.lit(shape.name).alias("fact"), F.sum("n").alias("n"), F.count("*").alias("cells"), F.sum("v").cast("double").alias("total"))
        for key, (_, name) in spec.fks.items():
            lost = fk_orphans(cells, key, dim, name).agg(F.count("*").alias(f"_{key}"))
            one = one.join(lost, F.lit(True))  # one row each
        one = one.withColumn("orphans", sum((F.col(f"_{k}") for k in spec.fks), F.lit(0).cast("long"))).drop(*(f"_{k}" for k in spec.fks))
        out = one if out is None else out.unionByName(one)
    return out


# --- sets of any size -----------------------------------------------------------------------------------------------

_NET = "string_agg(strlen({0}) || ':' || {0}, '' ORDER BY {0})"


def _chunk_sql(members: str, by: str, size: int) -> str:
    """CTEs m, p and c: members (by, item), their chunks' numbers, and the chunks."""
    return f"""m AS (SELECT DISTINCT * FROM ({members}) WHERE item IS NOT NULL), p AS (SELECT *, (row_number() OVER (PARTITION BY {by} ORDER BY item) - 1) // {size} AS chunk FROM m),
 c AS (SELECT {by}, chunk, count(*) AS n, min(item) AS first_item, max(item) AS last_item, sha256({_NET.format("item")}) AS digest FROM p GROUP BY {by}, chunk)"""


@query(f"""WITH RECURSIVE {_chunk_sql("SELECT 'all' AS scope, p_name AS item FROM part UNION ALL SELECT p_brand, p_name FROM part", "scope", 64)},
 l AS (SELECT 0 AS level, scope, chunk AS place, n, 1 AS chunks, digest FROM c
  UNION ALL SELECT level + 1, scope, place // 64, sum(n), sum(chunks), CASE WHEN count(*) = 1 THEN min(digest) ELSE sha256('+' || string_agg('64:' || digest, '' ORDER BY place)) END FROM l WHERE level < 6 GROUP BY level, scope, place // 64)
 SELECT scope, CAST(n AS BIGINT) AS n, CAST(chunks AS BIGINT) AS chunks, digest FROM l WHERE level = 6""")
def set_digests(spark, d):
    """The names of all parts as one set, and of each brand's: how many, in how many chunks of 64, and the set's digest."""
    p = table(spark, d, "part")
    rows = p.select(F.lit("all").alias("scope"), "p_name").unionByName(p.select(F.col("p_brand").alias("scope"), "p_name"))
    return sets.set_digests(sets.set_chunks(rows, ["scope"], "p_name", 64), ["scope"], 64)


@query(f"""WITH {_chunk_sql("SELECT p_brand, p_name AS item FROM part", "p_brand", 16)} SELECT {_KEY.format("p_brand", "brand")} AS brand_key, p_brand, chunk, n, first_item, last_item, digest FROM c""")
def label_chunks(spark, d):
    """The names of each brand's parts beside the brand's dimension, 16 to a row."""
    p = table(spark, d, "part")
    out = star.identity_labels([p.filter("p_size < 20"), p.filter("p_size >= 20")], "brand", ["p_brand"], "p_name", "brand_key", 16)
    return out.select("brand_key", "p_brand", "chunk", "n", F.col("items")[0].alias("first_item"), F.element_at("items", -1).alias("last_item"), "digest")


@query(f"""WITH {_chunk_sql("SELECT 'c' || o_custkey AS sha256, CAST(o_orderkey AS VARCHAR) AS item FROM orders", "sha256", 4)} SELECT sha256, chunk, n, first_item, last_item, digest FROM c WHERE sha256 IN (SELECT sha256 FROM m GROUP BY 1 HAVING count(*) > 1)""")
def same_content_chunks(spark, d):
    """Orders as files whose content is their customer: contents that several files have, their paths four to a row."""
    manifest = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.concat(F.lit("c"), "o_custkey").alias("sha256"))
    return files.same_content_chunks(manifest, 4).select("sha256", "chunk", "n", F.col("items")[0].alias("first_item"), F.element_at("items", -1).alias("last_item"), "digest")


@query(f"""WITH {_chunk_sql("""SELECT sha256('["' || l_returnflag || '","' || l_linenumber || '"]') AS fingerprint, l_orderkey || '-' || l_linenumber AS item FROM lineitem""", "fingerprint", 1024)} SELECT * FROM c""")
def layout_chunks(spark, d):
    """Lines as files whose header is their flag and number: the names of each layout's files, 1024 to a row."""
    header = F.array(F.col("l_returnflag"), F.col("l_linenumber").cast("string"))
    li = table(spark, d, "lineitem").select(header.alias("header"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("file"))
    out = profile.layout_chunks(li, "file", "header", 1024)
    return out.select("fingerprint", "chunk", "n", F.col("items")[0].alias("first_item"), F.element_at("items", -1).alias("last_item"), "digest")


# --- order, series and dead letters as checked properties -----------------------------------------------------------


@query(f"WITH {NATION} SELECT nation, year, metric, CAST(row_number() OVER (ORDER BY metric, year, nation) - 1 AS BIGINT) AS row_no FROM ny")
def ordered_report(spark, d):
    """The rows of a report with their numbers in its order."""
    return numbered(nation_year(spark, d), ["metric", "year", "nation"]).select("nation", "year", "metric", "row_no")


@query("""WITH q AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events) SELECT 'grain' AS "check", CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'gap:gap_days', 0 UNION ALL SELECT 'gap:bad_gap', count(*) FILTER (user_id % 5 = 0) FROM q""")
def gap_verifier(spark, d):
    """Days since a series' last observation confirm themselves; a copy that is wrong for every fifth user does not."""
    e = table(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("day")).distinct()
    mart = ts.observation_gap(e, ["user_id", "event_type"], "day")
    mart = mart.withColumn("bad_gap", F.when(F.col("user_id") % 5 == 0, F.coalesce("gap_days", F.lit(0)) + 1).otherwise(F.col("gap_days")))
    return marts.verify_mart(mart, ["user_id", "event_type", "day"], series={c: ("gap", ["user_id", "event_type"], "day", "day") for c in ("gap_days", "bad_gap")})


@query("""SELECT sha256('orders' || chr(31) || '{"o_orderkey":"' || o_orderkey || '","o_orderstatus":"' || o_orderstatus || '"}') AS id, sha256('{"o_orderkey":"' || o_orderkey || '"}') AS key_hash,
 CASE WHEN o_orderkey % 2 = 0 THEN 'run-1' ELSE 'run-2' END AS run_id, CASE WHEN o_orderkey % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS detected, 1 AS errors, CAST(0 AS BIGINT) AS mismatches FROM orders WHERE o_orderstatus = 'F'""")
def quarantine_replay(spark, d):
    """Dead letters of half the orders, then of all: known ids keep their first run and time, and no id stands for two
    payloads."""
    o = table(spark, d, "orders").withColumn("dq_errors", F.when(F.col("o_orderstatus") == "F", F.array(F.lit("closed"))).otherwise(F.array().cast("array<string>")))
    made = [quality.route_quarantine(o.filter(rows), "orders", run, ["o_orderkey"], ["o_orderkey", "o_orderstatus"], F.lit(day).cast("timestamp")) for rows, run, day in (("o_orderkey % 2 = 0", "run-1", "2024-01-01"), ("true", "run-2", "2024-01-02"))]
    wrong = quality.quarantine_mismatch(*made).agg(F.count("*").alias("mismatches"))
    merged = quality.merge_quarantine(*made).join(wrong, F.lit(True))  # one row
    return merged.select("id", "key_hash", "run_id", F.date_format("detected_at", "yyyy-MM-dd").alias("detected"), F.size("errors").alias("errors"), "mismatches")
