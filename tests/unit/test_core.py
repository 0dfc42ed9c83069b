"""Golden cases of single operators on a few rows."""

import datetime as dt
import hashlib
import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from quern.functions import clean, keys
from quern.operators import aggregates as agg
from quern.operators import joins, profile, quality, reshape, upsert
from quern.operators import timeseries as ts
from quern.plans import semantic, star
from quern.plans.contract import Contract, Field, Rule, normalize


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_paired_ratio_and_level(spark):
    df = spark.createDataFrame([(1, 10), (9, 18), (50, None), (0, 999)], "d int, n int")
    assert agg.paired_ratio(df, [], "n", "d").first().ratio == 2.8
    assert agg.paired_ratio(spark.createDataFrame([(1, 2), (3, 24)], "d int, n int"), [], "n", "d", 1000).first().ratio == 6500
    levels = spark.createDataFrame([("a", 2020, 5), ("a", 2020, 6), ("b", 2020, 1), ("b", 2021, 1), ("c", 2020, None)], "g string, y int, v int")
    assert rows(agg.period_level(levels, ["g"], "y", "v"), "g") == [("a", 11), ("b", None), ("c", None)]


def test_calendar_yoy_and_endpoints(spark):
    df = spark.createDataFrame([("s", 2020, 10), ("s", 2022, 5), ("s", 2023, 0), ("s", 2024, 8)], "g string, y int, v int")
    assert [r[-1] for r in rows(ts.calendar_yoy(df, ["g"], "y", "v").select("y", "yoy_pct"), "y")] == [None, None, -100.0, None]
    e = agg.endpoints(spark.createDataFrame([("s", 2020, 10), ("s", 2021, None), ("s", 2022, 40), ("t", 2020, 3)], "g string, y int, v int"), ["g"], "y", "v").orderBy("g").collect()
    assert (e[0].cagr_pct, e[0].peak_period, e[0].numeric_periods) == (pytest.approx(100), 2022, 2) and e[1].change_pct is None
    tie = agg.endpoints(spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, 3)], "y int, v int"), [], "y", "v").first()
    assert tie.peak_period == 2 and tie.peak_to_last_pct == pytest.approx(-200 / 3)


def test_dense_calendar_and_volatility(spark):
    day = lambda m, y=2024: dt.date(y, m, 1)
    df = spark.createDataFrame([(day(1), 10.0), (day(3), None), (day(4), 0.0)], "m date, v double").withColumn("g", F.lit("s"))
    dense = ts.dense_calendar(df, ["g"], "m")
    assert [(r.m.month, r.observed_row, r.v) for r in dense.orderBy("m").collect()] == [(1, True, 10.0), (2, False, None), (3, True, None), (4, True, 0.0)]
    long = spark.createDataFrame([("s", dt.date(2020 + i // 12, i % 12 + 1, 1), float(100 + (i * 7) % 5) if i != 20 else None) for i in range(40)], "g string, m date, v double")
    got = [r.volatility_12 for r in ts.log_volatility(long, ["g"], "m", "v").orderBy("m").collect()]
    assert got[11] is None and got[12] is not None and all(x is None for x in got[20:33]) and got[33] is not None
    means = [r.rolling_mean_12 for r in ts.rolling_mean(long, ["g"], "m", "v").orderBy("m").collect()]
    assert means[10] is None and means[11] is not None and means[31] is None and means[32] is not None


def test_deduplicate_prefers_recency_then_nulls_first(spark):
    df = spark.createDataFrame([("A", 1, 100, "x"), ("A", 2, 100, "b"), ("A", 2, 100, None), ("B", None, 1, "z"), ("B", None, 0, "z"), (None, 1, 1, "n")], "k string, ts long, value int, other string")
    want = [(None, 1, 1, "n"), ("A", 2, 100, None), ("B", None, 0, "z")]
    assert rows(upsert.deduplicate(df, ["k"], ["ts"]), "k") == want
    assert rows(upsert.deduplicate_by_window(df, ["k"], ["ts"]), "k") == want
    many = spark.range(400).selectExpr("id % 40 AS k", "nullif(id * 7 % 11, 3) AS a", "timestamp_micros(id * 13 % 5) AS t", "date_add(date'2024-01-01', int(id % 3)) AS d", "if(id % 17 = 0, double('NaN'), id * 5 % 4) AS x", "cast(id * 3 % 7 AS decimal(5,2)) AS p", "id % 2 = 0 AS b", "array(id % 9) AS l", "cast(id AS string) AS s")
    for order in (["a"], ["t", "a"], ["d"], ["x", "t"], ["p"], ["b"], ["s"], []):
        want = rows(upsert.deduplicate_by_window(many, ["k"], order).select("k", "s"), "k")
        assert rows(upsert.deduplicate(many, ["k"], order).select("k", "s"), "k") == want, order
        assert rows(upsert.deduplicate_in_phases(many, ["k"], order).select("k", "s"), "k") == want, order


def test_deduplicate_sorts_no_whole_table(spark):
    """A hot key with half of all rows, copies, ties, NULL keys, odd column names, equal zeros; and the plan."""
    many = spark.range(600).selectExpr("if(id % 2 = 0, 7, nullif(id % 300, 5)) AS `a.k`", "id % 3 AS _k0", "if(id % 50 = 1, -0.0D, double(id % 4)) AS _latest", "id % 5 AS _row", "cast(id % 20 AS string) AS s")
    many = many.union(many)
    for keys, order in ((["a.k"], ["_latest"]), (["a.k", "_k0"], ["_row", "_latest"]), ([], ["_latest"])):
        quoted = [f"`{k}`" for k in keys]
        got = upsert.deduplicate_in_phases(many, keys, order)
        assert got.columns == many.columns
        want = upsert.deduplicate(many, keys, order)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert got.count() == (many.select(*quoted).distinct().count() if keys else 1)
        assert upsert.deduplicate_in_phases(many.limit(0), keys, order).count() == 0 == upsert.deduplicate(many.limit(0), keys, order).count()
    plan = upsert.deduplicate_in_phases(many, ["a.k"], ["_latest"])._jdf.queryExecution().sparkPlan().toString()
    alone = plan[: plan.index("min_by")]
    assert "HashAggregate" in alone and "functions=[max(" in alone and "Sort " not in alone


def test_upsert(spark):
    target = spark.createDataFrame([("A", 1, 10, "keep"), ("B", 5, 20, "keep"), ("D", 3, None, "keep")], "k string, ts long, v int, extra string")
    incoming = spark.createDataFrame([("A", 2, 11), ("B", 4, 99), ("C", 1, 30), ("D", 3, None), (None, 1, 7)], "k string, ts long, v int")
    after = upsert.upsert(target, incoming, ["k"], "ts")
    assert rows(after, "k") == [(None, 1, 7, None), ("A", 2, 11, "keep"), ("B", 5, 20, "keep"), ("C", 1, 30, None), ("D", 3, None, "keep")]
    again = upsert.upsert(after.filter("k is not null"), incoming.filter("k is not null"), ["k"], "ts")
    assert again.exceptAll(after).isEmpty()
    assert upsert.changes(target, incoming.filter("k = 'D'"), ["k"], "ts").isEmpty()


def test_rules_unknown_fails_and_actions(spark):
    df = spark.createDataFrame([("a", 1, 2020), ("b", None, 2020), (None, -1, 1800), ("d", 5, 2021), ("e", -2, 2020)], "k string, value int, year int")
    rules = [Rule("key", "k IS NOT NULL"), Rule("positive", "value > 0"), Rule("year", "year BETWEEN 1900 AND 2100"), Rule("note", "year = 2020", action="LOG")]
    valid, bad = quality.apply_rules(df, rules)
    assert valid.count() == 2 and bad.count() == 3 and bad.agg(F.max(F.size("dq_errors"))).first()[0] == 3
    assert valid.filter("k = 'd'").first()._dq_warnings[0].rule_id == "note"
    letters = quality.route_quarantine(bad.unionByName(bad), "set", "r1", ["k"], ["k", "value", "year"])
    later = quality.route_quarantine(bad, "set", "r2", ["k"], ["k", "value", "year"])
    merged = quality.merge_quarantine(letters, later)
    assert letters.count() == merged.count() == 3 and {r.run_id for r in merged.collect()} == {"r1"} and quality.quarantine_mismatch(letters, later).isEmpty()


def test_conflicts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", None), (None, 3), (None, 4)], "k string, v int")
    assert rows(quality.flag_conflicts(df, ["k"], "v").select("k", "conflict").distinct(), "k") == [(None, True), ("a", True), ("b", False)]
    with pytest.raises(ValueError):
        quality.assert_no_conflicts(df, ["k"], ["v"])
    with pytest.raises(ValueError):
        quality.bounded(df, 5)
    data, structural = quality.structural_rows(spark.createDataFrame([("a", None), (" ", "\x00"), (None, None)], "x string, y string"), ["x", "y"])
    assert data.count() == 1 and structural.count() == 2


def test_contract(spark):
    contract = Contract("c", (Field("k", "string", "K"), Field("n", "int"), Field("x", "double"), Field("p", "decimal(5,2)", markers=("..",)), Field("o", "date", required=False)), ("k",))
    df = spark.createDataFrame([(" a ", "2020.0", "1e3", "12.30", 1), ("b", "2.5", "NaN", "..", 2), ("", "", "x", "1234.5", 3)], "K string, n string, x string, p string, _run int")
    got = normalize(df, contract).orderBy("_run").collect()
    assert (got[0].k, got[0].n, got[0].x, got[0].p, got[0].o, got[0]._payload) == ("a", 2020, 1000.0, D("12.30"), None, None)
    assert [e.failed_column for e in got[1]._cast_errors] == ["n", "x"] and got[1].p is None
    assert [e.failed_column for e in got[2]._cast_errors] == ["x", "p"] and got[2].k is None and got[2].n is None
    assert json.loads(got[2]._payload) == {"K": "", "n": "", "x": "x", "p": "1234.5"}
    with pytest.raises(ValueError):
        normalize(df.drop("n"), contract)
    for bad in (dict(keys=("zz",)), dict(rules=(Rule("r", "true", action="DROP"),))):
        with pytest.raises(ValueError):
            Contract("c", contract.fields, **({"keys": ("k",)} | bad))


def key(domain, values):
    """The canonical form, value by value."""
    import re

    slug = lambda t: re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]+", "_", "".join(keys.FOLDED.get(c, c) for c in t).lower())).strip("_")
    digest = hashlib.sha256(json.dumps(["K1", domain, values], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()
    tokens = [slug("true" if v is True else "false" if v is False else str(v)) for v in values if v is not None]
    whole = "_".join(t for t in tokens if t) or "k"
    if all(isinstance(v, str) and re.fullmatch("[a-z0-9]+(_[a-z0-9]+)*", v) for v in values) and len(whole) <= 64:
        return whole
    return f"{whole[:57].rstrip('_') or 'k'}_{digest[:6]}"


def test_keys(spark):
    texts = [("null", "a"), (None, "a"), ("Việt Nam", "é"), ("é", "é"), ("đường Ñ", "ß"), ("x" * 70, "y"), ("", " "), ('"q"\\', "tab\t"), ("clean_one", "2")]
    df = spark.createDataFrame(texts, "a string, b string")
    assert [r.k for r in df.select(keys.spark_key("dom", F.col("a"), F.col("b")).alias("k")).collect()] == [key("dom", list(t)) for t in texts]
    ints = spark.createDataFrame([(1, "1", True)], "i int, s string, t boolean").select(*(keys.spark_key("d", F.col(c)).alias(c) for c in "ist")).first()
    assert tuple(ints) == (key("d", [1]), "1", key("d", [True]))
    with pytest.raises(TypeError):
        keys.checked_key(spark.range(1).select(F.lit(1.5).alias("f")), "d", ["f"])
    labels = spark.createDataFrame([('[{"label":"b"},{"label":null},{"label":"a"},{"label":"b"}]',)], "j string")
    assert labels.select(keys.source_labels(F.col("j"))).first()[0] == "b | a"


def test_cleaning(spark):
    def one(c, *values):
        return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(c(F.col("v"))).collect()]

    assert one(clean.identifier, "'704", "113.0", " 12.00", "a.0b", "") == ["704", "113", "12", "a.0b", None]
    assert one(lambda c: clean.pad_code(c), "4", "04", "1234", "x") == ["004", "004", "1234", "x"]
    assert one(lambda c: clean.restore_code(c, {"113": "0113"}), "113", "5") == ["0113", "5"]
    assert one(clean.year4, "2020", "20x0", "20200") == [2020, None, None]
    assert one(clean.negative_flag, "-0.001", "0", "x", None) == [True, False, False, False]
    assert one(lambda c: clean.parse_dates(c), "3/4/2024 12:05:00 AM", "2024-03-04", "13/13/2024 1:00:00 AM", "4.3.2024") == [dt.date(2024, 3, 4), dt.date(2024, 3, 4), None, None]
    assert one(lambda c: clean.parse_grouped_number(c), "1,234.5", "12,34", "1234", "x") == [D("1234.50"), None, D("1234.00"), None]
    assert one(clean.strict_numeric, "1.5", "1e3", "-1", "1.123456789", "1.1234567800") == [True, False, False, False, True]
    assert one(lambda c: clean.parse_yyyymm(c)["period_date"], "1960M01", "1960M13") == [dt.date(1960, 1, 1), None]
    value, ok = clean.checked_decimal(F.col("v"), 1000, 6, 1)
    got = spark.createDataFrame([("1.5",), ("1.23456",), ("999999",), (None,)], "v string").select(value, ok).collect()
    assert [tuple(r) for r in got] == [(D("1500.0"), True), (None, False), (None, False), (None, True)]
    assert clean.sanitize("2020 Giá--trị") == "col_2020_gi_tr_"
    with pytest.raises(ValueError):
        clean.sanitize_columns(spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int"))
    months = clean.decode_period(spark.createDataFrame([("7001",), ("7021",), ("x",)], "c string"), "c").collect()
    assert [(r.month, r.time_grain) for r in months] == [(1, "monthly"), (None, "annual"), (None, None)]


def test_pivots(spark):
    df = spark.createDataFrame([(1, "5312", None), (1, "5510", D(5)), (2, "5312", D(2)), (2, "5510", D(3)), (3, "5312", D(0)), (3, "5510", D(1)), (4, "5412", None)], "k int, metric string, value decimal(18,2)")
    wide = semantic.production_yield(df, ["k"])
    got = {r.k: (r.present_5312, r.present_5412, r.computed_yield_kg_ha) for r in wide.collect()}
    assert got == {1: (1, 0, None), 2: (1, 0, 1500.0), 3: (1, 0, None), 4: (0, 1, None)}
    assert reshape.pivot_mismatch(wide, df, ["k"], "metric", "value", semantic.PRODUCTION).isEmpty()
    assert reshape.pivot_mismatch(wide, df.filter("k > 1"), ["k"], "metric", "value", semantic.PRODUCTION).count() == 2
    series = spark.createDataFrame([("1960M01", "5", None)], "period string, rice_usd_t string, commodity_3_x string")
    assert rows(reshape.unpivot_series(series, "period", {"usd_t": "USD/t"}), "period") == [("1960M01", "rice", "USD/t", "5")]
    with pytest.raises(ValueError):
        reshape.unpivot_series(series.withColumn("commodity_3_x", F.lit("1")), "period", {"usd_t": "USD/t"})
    with pytest.raises(ValueError):
        reshape.unpivot_periods(spark.createDataFrame([("1",)], "col_2000_2002 string"))
    files = spark.createDataFrame([("f1", "north", "1", "2"), ("f2", "south", "3", None)], "file string, place string, a string, b string")
    layouts = [{"files": {"f1": {"stat": "area"}}, "keys": ["place"], "values": {"a": "2020", "b": "2021"}}, {"files": {"f2": {"stat": "yield"}}, "keys": ["place"], "values": {"a": "2020"}}]
    assert rows(reshape.unpivot_layouts(files, "file", layouts), "file", "measure") == [("f1", "area", "north", "2020", "1"), ("f1", "area", "north", "2021", "2"), ("f2", "yield", "south", "2020", "3")]
    table = spark.createDataFrame([("x", 1), ("y", 2)], "src string, v int")
    assert rows(reshape.replace_branch(table, spark.createDataFrame([("x", 9)], "src string, v int"), "src", "x"), "src") == [("x", 9), ("y", 2)]


def test_null_shift_is_seen(spark):
    a, b = (spark.createDataFrame([r], "x string, y string") for r in (("a", None), (None, "a")))
    assert joins.multiset_diff(a, b).count() == 2
    assert agg.content_checksum(a).first().checksum != agg.content_checksum(b).first().checksum


def test_identities(spark):
    df = spark.createDataFrame([(1, 10.0, 2.0, 20.0), (2, 10.0, 2.0, 28.0), (3, 10.0, None, 20.0)], "k int, x double, y double, z double")
    assert rows(joins.product_identity(df, ["k"], "x", "y", "z").select("k", "ok"), "k") == [(1, True), (2, False)]
    parts = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "t", 4), (2, "a", 1), (2, "t", 1)], "k int, p string, v int")
    assert rows(joins.parts_vs_total(parts, ["k"], "p", "v", "t", ["a", "b"], "0.5").select("k", "ok"), "k") == [(1, True)]
    dim = spark.createDataFrame([(1, "x"), (2, "x")], "k int, n string")
    assert joins.resolve_member(dim, k=1).n == "x"
    with pytest.raises(LookupError):
        joins.resolve_member(dim, n="x")
    assert rows(joins.common_periods(spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "g string, y int"), "g", "y"), "y") == [(1,)]


def test_star(spark):
    spec = star.TableSpec("f", {"k": "int", "d": "int", "v": "decimal(10,2)"}, ("k",), (("d", "v"),), ("d",), {"d": ("dim", "id")})
    dim = spark.createDataFrame([(1, "s")], "id int, src string")
    fact = spark.createDataFrame([(1, 1, D(1)), (1, 2, D(2)), (3, None, D(3))], "k int, d int, v decimal(10,2)")
    got = {r.check: r.violations for r in star.validate_table(fact, spec, {"dim": dim}).collect()}
    assert got == {"schema": 0, "not_null:d": 1, "not_null:k": 0, "pk": 1, "unique:d,v": 0, "fk:d": 1}
    metrics = spark.createDataFrame([("stock", "NO_SUM_OVER_TIME"), ("rate", "NEVER_SUM"), ("flow", "SIGNED_FLOW")], "metric string, additivity string")
    obs = spark.createDataFrame([("stock", 2020, 1), ("stock", 2021, 2), ("flow", 2020, 3), ("flow", 2021, -4), ("rate", 2020, 5)], "metric string, year int, value int")
    assert rows(star.safe_sum(obs, metrics, ["metric", "year"], "year"), "metric", "year")[0] == ("flow", 2020, 3)
    assert star.safe_sum(obs.filter("metric = 'flow'"), metrics, ["metric"], "year").first().total == -1
    for by, only in ((["metric"], "stock"), ([], "rate")):
        with pytest.raises(Exception, match="additivity"):
            star.safe_sum(obs.filter(F.col("metric") == only).unionByName(obs.filter(F.col("metric") == only)), metrics, by, "year").collect()
    with pytest.raises(ValueError):
        star.metric_dim(obs.withColumn("unit", F.lit("?")), metrics.withColumns({"unit": F.lit("t"), "unit_to": F.lit("t"), "factor": F.lit(1)}))
    years, months, days = star.calendar_dims(spark.createDataFrame([(dt.date(2023, 11, 30), dt.date(2024, 3, 1))], "a date, b date"))
    assert years.count() == 2 and months.count() == 15 and days.count() == 93 and quality.check_calendar(days).isEmpty()
    with pytest.raises(ValueError):
        agg.assert_fd(spark.createDataFrame([("a", "t"), ("a", None)], "i string, u string"), ["i"], ["u"])


def test_templates(spark):
    fact = spark.createDataFrame([(2020, "g", "p", "m", "t", 1.0, "s", "all"), (2021, "g", "q", "m", "t", None, "s", "all")], "year int, geography string, product string, metric string, unit string, value double, source string, scope string")
    t = semantic.Templates(fact)
    for name in t.NAMES:
        assert t.run(name).count() >= 1, name
    assert t.run("fact_overview", year_from=2021).first().missing_observations == 1
    for bad in (dict(year_from="2020"), dict(zz=1), dict(year_to=1)):
        with pytest.raises(ValueError):
            t.run("catalogue", **bad)
    with pytest.raises(ValueError):
        semantic.Templates(fact, most=1).run("nso_observations")


def test_profiles(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "007"), (None, "x"), ("b", "-")], "k string, v string")
    got = {r.column: r for r in profile.schema_profile(df).collect()}
    assert (got["v"].numeric, got["v"].non_numeric, got["v"].leading_zeros, got["k"].nulls) == (2, 2, 1, 1)
    nums = spark.createDataFrame([("g", str(v)) for v in (1, 2, 3, 4, 5, 6, 7, 100)] + [("h", "1")], "g string, v string")
    assert rows(profile.numeric_profile(nums, "v", ["g"]).select("g", "outliers"), "g") == [("g", 1), ("h", 0)]
    assert profile.header_problems(["a", " b", "", "a", "_c3"]) == [("", "blank"), (" b", "padded"), ("a", "repeated"), ("_c3", "generated")]
    assert rows(profile.precision_histogram(df.select(F.lit("1.250").alias("v")), "v"), "decimals") == [(3, 4)]
