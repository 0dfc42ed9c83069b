import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import quantiles, sets


def test_quantiles_of_awkward_numbers(spark):
    rng = random.Random(1)
    inf = float("inf")
    groups = {
        "plain": [rng.gauss(0, 10) for _ in range(500)], "ties": [rng.choice([1.5, 2.5, 2.5000000001]) for _ in range(300)], "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(400)],
        "close": [1.7e9 + i * 2.0**-22 for i in range(300)] + [1.79e9], "one": [7.0], "two": [1.0, 2.0], "odd": [inf, -inf, 0.0, -0.0, 5e-324, -5e-324, 1.7e308], None: [3.0, 1.0, 2.0], "none": [None, None],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("plain", None)]
    df = spark.createDataFrame(rows, "g string, v double").withColumns({"_total": F.lit(1), "quantiles": F.lit("clash")})
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {x.g: x for x in quantiles.exact_quantiles(df, ["g"], "v", shares).collect()}
    assert set(got) == set(groups) - {"none"}
    for g, x in got.items():
        vs = sorted(groups[g])
        assert x.n == len(vs)
        for s, q in zip(shares, x.quantiles):
            p = s * (len(vs) - 1)
            low, part = int(p), p - int(p)
            want = vs[low] if part == 0 else (1 - part) * vs[low] + part * vs[low + 1]
            assert q == want or np.isnan(q) and np.isnan(want), (g, s)
    nan = quantiles.exact_quantiles(spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)], "v double"), [], "v", [0.5, 1.0]).first()
    assert nan.quantiles[0] == 2.0 and np.isnan(nan.quantiles[1])
    assert quantiles.exact_quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0
    assert quantiles.exact_quantiles(df.limit(0), [], "v", [0.5]).count() == 0


def test_no_task_of_a_quantile_holds_a_group(spark):
    df = spark.range(0, 400_000, 1, 16).select((F.col("id") * 37 % 400_000).cast("double").alias("v"))
    plan = quantiles.exact_quantiles(df, [], "v", [0.5])._jdf.queryExecution().toString()
    assert "percentile" not in plan.lower()
    assert quantiles.exact_quantiles(df, [], "v", [0.25, 0.5]).first().quantiles == [99999.75, 199999.5]


def test_index_of_parts(spark, tmp_path):
    from quern.sources import index, store

    tables = store.TableStore(spark, str(tmp_path / "tables"))
    frame = lambda lo, hi, step, ts: spark.range(lo, hi, step).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"), F.lit(ts).alias("ts"))
    for df in (frame(0, 5000, 2, 1), frame(1, 5000, 2, 1), frame(10_000, 12_000, 1, 1)):
        store.upsert_table(tables, "t", df, ["k", "name"], "ts")
    parts = tables.parts("t")
    assert len(parts) == 3
    near = lambda df: index.parts_that_may_hold(tables, "t", parts, df, ["k", "name"])
    assert near(frame(11_000, 11_010, 1, 2)) == parts[2:] and near(frame(20_000, 20_010, 1, 2)) == [] and near(frame(-9, -1, 1, 2)) == []
    for i in (0, 1):  # every key of a part leads to it, also one at a time
        assert parts[i] in near(frame(i, 5000, 2, 2))
    for k in (0, 1, 2498, 4999):
        assert parts[k % 2] in near(frame(k, k + 1, 1, 2))
    misses = sum(len(near(frame(6000 + k, 6001 + k, 1, 2))) for k in range(3))
    assert misses == 0  # within no part's bounds
    wrong = [(2 * k, f"n{2 * k + 1}") for k in range(200)]  # keys of no part, within the bounds of two
    assert len(near(spark.createDataFrame(wrong[:3], "k long, name string"))) <= 1
    assert near(spark.createDataFrame([(None, "n1")], "k long, name string")) == []
    tables.replace("t", [], [tables.write_part("t", frame(7000, 7010, 1, 1))])  # without an index: always read
    assert index.parts_that_may_hold(tables, "t", tables.parts("t"), frame(20_000, 20_001, 1, 2), ["k", "name"]) == tables.parts("t")[3:]
    version = store.upsert_table(tables, "t", frame(4998, 7002, 1, 2), ["k", "name"], "ts")
    got = tables.read("t", version)
    assert got.count() == 5000 + 2000 + 10 + 2000 and got.filter("ts = 2").count() == 2004
    gone = store.clean_up(tables, "t")
    assert gone and tables.versions("t") == [version] and tables.read("t").count() == 9010
    assert not tables._fs().exists(tables._path("_plans", "x")) and not [s for s in tables._fs().listStatus(tables._path("_plans"))]


def test_trees_find_what_differs(spark, tmp_path):
    from quern.sources import index, store

    tables = store.TableStore(spark, str(tmp_path / "tables"))
    df = spark.range(2000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("a"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("b"), F.array("id").alias("list"))
    index.write_with_tree(tables, "t", df, ["k"])
    for name, other, want in (
        ("moved", df.withColumns({"a": F.when(F.col("k") == 30, F.col("b")).otherwise(F.col("a")), "b": F.when(F.col("k") == 30, F.lit(None)).otherwise(F.col("b"))}), [(30, -1), (30, 1)]),
        ("gone", df.filter("k <> 7 AND k <> 8"), [(7, 1), (8, 1)]), ("twice", df.unionByName(df.filter("k = 9")), [(9, -1)]), ("equal", df.repartition(5), []),
    ):
        index.write_with_tree(tables, name, other, ["k"])
        rows, leaves = index.differing_rows(tables, "t", name)
        assert sorted((r.k, r.surplus) for r in rows.collect()) == want and len(leaves) == len({k for k, _ in want})
        found, seen = index.differing_leaves(index.tree(tables, "t"), index.tree(tables, name))
        assert found == leaves and seen == 1 if not want else seen <= 1 + 2 * index.LEVELS * index.FAN
    index.write_with_tree(tables, "empty", df.limit(0), ["k"])
    assert index.differing_rows(tables, "empty", "t")[0].count() == 2000


def test_ranges_of_files(spark, tmp_path):
    import hashlib

    from quern.sources import files, ranges

    folder = tmp_path / "files"
    (folder / "sub").mkdir(parents=True)
    content = {"a.bin": b"x\n" * 3000, "sub/b.bin": bytes(range(256)) * 9, "empty": b"", "sub/_hidden": b"no", ".also": b"no"}
    for name, data in content.items():
        (folder / name).write_bytes(data)
    shown = {k: v for k, v in content.items() if "_" not in k and "." != k[0]}
    got = {r.path.removeprefix(f"{folder}/"): (r.bytes, r.sha256) for r in files.file_manifest(spark, str(folder)).collect()}
    assert got == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in shown.items()}
    parts = ranges.file_ranges(spark, f"file:{folder}", "ranges", rangeBytes=1000, taskBytes=100_000).collect()
    assert sorted(r.start for r in parts if r.path.endswith("a.bin")) == [0, 1000, 2000, 3000, 4000, 5000] and sum(r.newlines for r in parts) == sum(v.count(b"\n") for v in shown.values())
    assert {r.path.rsplit("/", 1)[1] for r in ranges.file_ranges(spark, f"{folder}/*/*.bin").collect()} == {"b.bin"}
    assert {r.path.rsplit("/", 1)[1] for r in ranges.file_ranges(spark, f"{folder}/s*").collect()} == {"b.bin"}
    assert ranges.file_ranges(spark, f"{folder}/none").count() == 0
    big = tmp_path / "big"
    with open(big, "wb") as f:  # a hole of over 2 GB: not held, and read in pieces
        f.truncate((1 << 31) + 5)
    row = ranges.file_ranges(spark, str(big)).first()
    assert row.length == (1 << 31) + 5 and row.head == bytes(1024)
    whole = hashlib.sha256()
    for _ in range(2048):
        whole.update(bytes(1 << 20))
    whole.update(bytes(5))
    assert files.file_manifest(spark, str(big)).first().sha256 == whole.hexdigest()


def test_a_thousand_files_in_few_jobs(spark, tmp_path):
    from quern.sources import ranges

    heads = ['a,"b, ""quoted""\nname"', "a,c", "﻿c,d"]
    for i in range(1000):
        (tmp_path / f"{i}.csv").write_text(f"{heads[i % 3]}\n{i},x\n", encoding="utf-8")
    (tmp_path / "blank.csv").write_text("")
    spark.sparkContext.setJobGroup("layouts", "")
    got = ranges.read_layouts(spark, str(tmp_path)).collect()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("layouts")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(got) == 1000 and len(jobs) <= 5
    assert {c for c in got[0].asDict()} == {"a", 'b, "quoted"\nname', "c", "d", "_source_file"}
    for r in got:
        i = int(r._source_file.rsplit("/", 1)[1][:-4])
        want = [{"a": str(i), heads[0][3:-1].replace('""', '"'): "x"}, {"a": str(i), "c": "x"}, {"c": str(i), "d": "x"}][i % 3]
        assert {k: v for k, v in r.asDict().items() if v is not None and k != "_source_file"} == want
    (tmp_path / "clash.csv").write_text("a,a\n1,2\n")
    with pytest.raises(ValueError, match="collide"):
        ranges.read_layouts(spark, str(tmp_path))
    with pytest.raises(Exception, match="longer than 4 bytes"):
        ranges.headers(spark, str(tmp_path), head=4).collect()


def test_segments_equal_whole_series(spark):
    from pyspark.sql import Window

    from quern.operators import segments

    rng = random.Random(5)
    rows = [(g, i, rng.random() * 10 if rng.random() > 0.1 else None) for g, n in (("a", 1000), ("b", 7), (None, 60), ("c", 1)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, at int, v double").repartition(5)
    w = Window.partitionBy("g").orderBy("at").rowsBetween(-4, 0)
    whole = {(r.g, r.at): (r.s, r.n) for r in df.select("g", "at", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("n")).collect()}

    def compute(part, by, period):
        own = Window.partitionBy(*by).orderBy(period).rowsBetween(-4, 0)
        return part.withColumns({"s": F.sum("v").over(own), "n": F.count("v").over(own)})

    for size in (4, 16, 100, 5000):
        got = segments.over_segments(df, ["g"], ["at"], 4, compute, size)
        assert got.columns == ["g", "at", "v", "s", "n"]
        assert {(r.g, r.at): (r.s, r.n) for r in got.collect()} == whole
    cut_ = segments.in_segments(df, ["g"], ["at"], 4, 16)
    assert max(r["count"] for r in cut_.groupBy("g", "_segment").count().collect()) <= 20
    with pytest.raises(ValueError):
        segments.in_segments(df, ["g"], ["at"], 5, 4)
    assert segments.over_segments(df.limit(0), [], ["at"], 2, lambda p, by, at: p, 10).count() == 0


def test_measures_and_their_rules(spark):
    from quern.plans.measures import Count, Growth, LastNonEmpty, Rank, Ratio, Sum, YearBefore, evaluate

    rows = [("x", "p", 2000, 10.0, 2.0), ("x", "p", 2001, None, 1.0), ("x", "q", 2000, 5.0, 0.0), ("y", "p", 2000, 1.0, 1.0), ("y", "p", 2001, 4.0, 1.0), (None, "q", 2001, 7.0, None)]
    df = spark.createDataFrame(rows, "g string, item string, year int, v double, w double")
    measures = {"v": Sum("v"), "n": Count("v"), "last": LastNonEmpty("v"), "ratio": Ratio(Sum("v"), Sum("w"), 10), "before": YearBefore(Sum("v")), "growth": Growth(LastNonEmpty("v")), "rank": Rank(Sum("v"), ("year",))}
    got = {(r.scope, r.g, r.item, r.year): tuple(r)[4:] for r in evaluate(df, measures, [(), ("g",), ("year", "g")], ["g", "item", "year"], "year").collect()}
    assert got == {
        ("", None, None, None): (27.0, 5, 11.0, 54.0, None, None, 1),
        ("g", "x", None, None): (15.0, 2, 15.0, 50.0, None, None, 1), ("g", "y", None, None): (5.0, 2, 4.0, 25.0, None, None, 3), ("g", None, None, None): (7.0, 1, 7.0, None, None, None, 2),
        ("g,year", "x", None, 2000): (15.0, 2, 15.0, 75.0, None, None, 1), ("g,year", "x", None, 2001): (None, 0, None, None, 15.0, None, None),
        ("g,year", "y", None, 2000): (1.0, 1, 1.0, 10.0, None, None, 2), ("g,year", "y", None, 2001): (4.0, 1, 4.0, 40.0, 1.0, 300.0, 2), ("g,year", None, None, 2001): (7.0, 1, 7.0, None, None, None, 1),
    }
    level = {"stock": LastNonEmpty("v", never_over=("item", "year"))}
    with pytest.raises(ValueError, match="stock must not be summed over item"):
        evaluate(df, level, [("g",)], ["g", "item", "year"], "year")
    assert evaluate(df, level, [("g", "item")], ["g", "item", "year"], "year").count() == 4  # a level goes by its last year
    with pytest.raises(ValueError, match="summed over year"):
        evaluate(df, {"v": Sum("v", ("year",))}, [("g", "year"), ("g",)], ["g", "item", "year"], "year")
    with pytest.raises(ValueError, match="unknown"):
        evaluate(df, {"v": Sum("v")}, [("z",)], ["g", "item", "year"], "year")


def test_intervals_and_ledger(spark):
    from quern.functions import intervals as iv
    from quern.operators import ledger

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    near = lambda x, low, high: x is not None and abs(x.low - low) < 1e-9 and abs(x.high - high) < 1e-9
    text = lambda s: iv.interval(F.lit(s))
    assert near(one(text("1.20")), 1.195, 1.205) and near(one(text(" -7 ")), -7.5, -6.5) and one(text("1e3")).low is None and one(text("")).high is None
    assert near(one(iv.plus(text("1"), text("2.0"))), 2.45, 3.55) and near(one(iv.minus(text("1"), text("2.0"))), -1.55, -0.45)
    assert near(one(iv.times(text("-1"), text("2"))), -3.75, -0.75) and near(one(iv.hull(text("1"), text("4"))), 0.5, 4.5)
    assert one(iv.meets(text("1.2"), text("1.3"))) and not one(iv.meets(text("1.2"), text("1.31"))) and one(iv.times(text("x"), text("2"))).low is None and one(iv.hull(text("x"), text("2"))).low is None and near(one(iv.scaled(text("1"), -2)), -3, -1)
    assert abs(one(iv.distance(text("1.0"), text("2.0"))) - 0.9) < 1e-9
    left = spark.createDataFrame([(1, "2.0"), (2, "5"), (3, None), (4, "9.99")], "k int, v string")
    right = spark.createDataFrame([(1, "2.04"), (2, "6.5"), (3, "1"), (5, "1")], "k int, v string")
    parts = spark.createDataFrame([(1, "1.0"), (1, "1.0"), (2, "2.0"), (2, "2.5"), (4, "9")], "k int, v string")
    rows = ledger.cross_source_ledger(
        ledger.equal_values("a", left, right, ["k"], "v"), ledger.equal_values("b", left, right.union(right), ["k"], "v"), ledger.parts_and_total("c", parts, left, ["k"], "v", 2),
        ledger.equal_values("d", left, right.limit(0), ["k"], "v", "VERIFIED_ENCODING"),
    ).collect()
    assert [(r.relation, r.status, r.matched, r.outside, r.finding) for r in rows] == [
        ("a", "DIAGNOSTIC", 2, 1, "differs beyond its digits"), ("b", "INCOMPATIBLE", 0, None, "not compared"), ("c", "DIAGNOSTIC", 2, 0, "agrees within its digits"), ("d", "VERIFIED_ENCODING", 0, 0, "nothing matched"),
    ]
    assert abs(rows[0].max_distance - 0.95) < 1e-9
    with pytest.raises(ValueError):
        ledger.equal_values("e", left, right, ["k"], "v", "FINE")


def net_digest(parts, mark=""):
    return hashlib.sha256((mark + "".join(f"{len(p.encode())}:{p}" for p in parts)).encode()).hexdigest()


def tree_digest(items, size):
    level = [net_digest(items[i : i + size]) for i in range(0, len(items), size)]
    n = len(level)
    while len(level) > 1:
        level = [net_digest(level[i : i + size], "+") if i + 1 < len(level) else level[i] for i in range(0, len(level), size)]
    return n, level[0]


@pytest.mark.parametrize("size", [2, 3, 50])
def test_sets_in_chunks(spark, size):
    rng = random.Random(size)
    groups = {"many": [f"{rng.randrange(60)}" for _ in range(400)], "odd": ["", "é", "\U0001f600", "z", "\uffff", "1:a", "a" * 70_000, "", None], "one": ["x", "x", None], None: ["b", "a"], "none": [None, None]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "chunk string, digest string").withColumns({"_item": F.lit("clash"), "items": F.lit(1)})
    made = sets.set_chunks(df, ["chunk"], "digest", size).toDF("g", "chunk", "n", "items", "digest")
    got = {}
    for r in sorted(made.collect(), key=lambda r: r.chunk):
        assert r.n == len(r["items"]) <= size and r.digest == net_digest(r["items"])
        got.setdefault(r.g, []).append(r)
    want = {g: sorted({v for v in vs if v is not None}, key=str.encode) for g, vs in groups.items()}
    assert set(got) == {g for g, vs in want.items() if vs}
    for g, chunks in got.items():
        assert [r.chunk for r in chunks] == list(range(len(chunks))) and all(r.n == size for r in chunks[:-1])
        assert [v for r in chunks for v in r["items"]] == want[g]
    totals = {r.g: (r.n, r.chunks, r.digest) for r in sets.set_digests(made, ["g"], size).collect()}
    for g in got:
        n, digest = tree_digest(want[g], size)
        assert totals[g] == (len(want[g]), n, digest)
    shared = sets.shared_members(df, ["chunk"], "digest", size).toDF("g", "chunk", "n", "items", "digest")
    assert {r.g for r in shared.collect()} == {g for g in got if len(want[g]) > 1}


def test_sets_of_nothing_and_of_all(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "v string")
    assert [(r.chunk, r["items"]) for r in sets.set_chunks(df, [], "v", 2).collect()] == [(0, ["a", "b"])]
    assert sets.set_digests(sets.set_chunks(df, [], "v", 2), [], 2).first().n == 2
    for by in ([], ["v"]):
        none = sets.set_chunks(df.limit(0), by, "v")
        assert none.count() == 0 and sets.set_digests(none, by).count() == 0
    with pytest.raises(ValueError, match="two"):
        sets.set_chunks(df, [], "v", 1)


def test_equal_sets_have_equal_digests_however_they_lie(spark):
    a = spark.range(3000).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("v"))
    one = sets.set_digests(sets.set_chunks(a.repartition(7), [], "v", 32), [], 32).first()
    two = sets.set_digests(sets.set_chunks(a.unionByName(a.filter("v < 'i5'")).repartition(3), [], "v", 32), [], 32).first()
    less = sets.set_digests(sets.set_chunks(a.filter("v <> 'i77'"), [], "v", 32), [], 32).first()
    assert one == two and one.digest != less.digest and one.chunks == 94
