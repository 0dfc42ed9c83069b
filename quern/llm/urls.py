"""URL filters: rules on host and path, and logistic regression on hashed character n-grams for the rest.

DataFrame and SQL functions only: no Python runs on the executors."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.shared import cut, remove

#: (verdict, host and path prefix): a rule fits its host and all subdomains.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

#: Word stems of unwanted urls, words that push, plain word stems, and plain words that look like unwanted ones.
UNWANTED = """adult porn xxx nude escort webcam hookup fetish erotic milf stripper swinger casino poker roulette slots jackpot bets betting
lottery bingo blackjack baccarat sportsbook wager gambling prize giveaway pills viagra cialis meds steroids pharmacy tramadol xanax valium
botox slimming detox payday loans credit debt mortgage refinance forex bitcoin airdrop trading invest spam clickbait popup tracker adserver
warez torrent cracked keygen serial nulled replica counterfeit rolex handbag followers likes seo backlinks dating singles brides""".split()
PUSHY = "free best cheap buy online win bonus hot live vip instant easy fast deal discount sale now offer real sexy top cash guaranteed secret".split()
PLAIN = """library museum school garden recipes weather history science travel music kitchen bicycle forest river railway theatre research support
manual archive journal council village bakery painting astronomy grammar pottery harbour orchard lantern meadow carpenter language physics
chemistry geology parish choir rowing football walking cycling sailing bridge castle abbey market farm nursery clinic hospital dentist
engineer lecture student teacher college faculty poetry novel reading letters maps atlas climate birds insects botany fishing weaving knitting
sewing cooking bread cheese honey tea coffee timber stone copper glass paper printing software compiler network database kernel python
gardening films townhall books blog news forum""".split()
CLOSE = """sussex adulthood alphabet better pillow caterpillar nudge escorial jackdaw lotus surprise slotted torrential casing spanish loaned
crackers medieval pokey trackside accredited traded seoul serialised dated investigate pharmacology""".split()
#: Syllables of invented names, which are plain: most hosts carry names that no list has.
SYLLABLES = "ba the ro lin the tion mar ka sel ver ing to den an er ist on mi th or na".split()
#: Tails of hosts. Each kind of url has those of the other at times, so that none tells everything.
TAILS = "com org net example.org example.com example.net co.uk edu de fr eu".split()
ODD_TAILS = "xyz top click bid icu biz info loan".split()

# s, t: stem (inflected) and host's tail; m, k: pushing words; a, b: plain words; n: digits; x: hexadecimal digits
_BAD_HOSTS = "{m}-{s}.{t} {s}{m}.{t} {s}-{m}-{k}.{t} www.{m}{s}{n}.{t} {s}{n}.{t} {m}-{k}-{s}.{t} {s}.{t} www.{s}-{b}.{t} {b}{s}.{t} m.{s}-{m}{n}.{t} blog.{b}-{s}.{t} {s}4u.{t}".split()
_BAD_PATHS = "/{m}-{s} /go/{s}/{n} /{m}-{s}-{k}-{n}.html /{s}/{m}.php /aff/{n}/{s} /promo/{m}/{s} /{b}/{m}-{s}-{k} /out/{x}/{s}{n} /{s}_{m}_{k}".split()
_ANY_PATHS = ["", "/", "/en/{n}", "/{b}/{n}.html", "/{b}/", "/de/{n}/", "/?page=2"]
_GOOD_HOSTS = "{a}.{t} www.{a}-{b}.{t} {b}{a}.{t} {a}-{b}.{t} blog.{b}-{a}.{t} m.{a}{b}.{t} {b}.{a}.{t} www.{a}.{t} {a}{n}.{t}".split()
_GOOD_PATHS = "/{a} /{a}/{b}.html /2021/05/{b}-{a} /{b}/{a}?id=7 /en/{a}/{n} /{b}_{a}/#top /wiki/{a}_{b} /docs/{a}/{x} /{a}-{b}-and-{b}-{n}.html /fr/{n} /search/{a}".split()


def _pick(choices, *place):
    """One of the choices, by a hash of the place alone."""
    return choices[crc32(repr(place).encode()) % len(choices)]


def _plain_word(*place) -> str:
    kind = _pick(range(4), "kind", *place)
    if kind == 0:  # an invented name
        return "".join(_pick(SYLLABLES, "syllable", j, *place) for j in range(2 + crc32(repr(place).encode()) // 7 % 2))
    return _pick(CLOSE if kind == 1 else PLAIN, "word", *place)


def _inflected(stem: str, *place) -> str:
    """A stem as it stands, with an ending, or with digits for letters."""
    return _pick((stem, stem, stem + "s", stem + "z", stem + "er", stem.replace("o", "0").replace("e", "3")), "form", *place)


def labelled_rows(per_stem: int = 24) -> list[tuple[str, int, str]]:
    """The small labelled table (url, label, stem), made by rule from the parts above: 1 is unwanted; the stem is what a
    url was made from, for tests that hold stems out.

    An unwanted url is so by its host, its path or both. Most, not all, unwanted ones also push, carry digits, chains of
    hyphens or odd tails, and some plain ones do, so that neither the stem nor the shape tells everything."""
    out: dict[str, tuple[int, str]] = {}

    def parts(stem: str, i: int, label: int) -> dict[str, str]:
        place = (stem, i, label)
        odd = _pick(range(16), "odd", *place) < (6 if label else 1)
        word = lambda name: _pick(PUSHY, name, *place) if _pick(range(4), "pushing", *place) else _plain_word(name, *place)
        return {
            "s": _inflected(stem, *place), "a": stem, "b": _plain_word("b", *place), "m": word("m"), "k": _pick(PUSHY, "k", *place),
            "n": str(crc32(repr(("n", *place)).encode()) % _pick((10, 100, 1000, 100000), "size", *place)), "x": f"{crc32(repr(('x', *place)).encode()):08x}",
            "t": _pick(ODD_TAILS if odd else TAILS, "tail", *place),
        }

    for stem in UNWANTED:
        for i in range(per_stem):
            values = parts(stem, i, 1)
            where = _pick(("host", "host", "both", "path"), "where", stem, i)
            host = _pick(_GOOD_HOSTS if where == "path" else _BAD_HOSTS, "host", stem, i)
            path = _pick(_ANY_PATHS if where == "host" else _BAD_PATHS, "path", stem, i)
            values |= {"a": _plain_word("a", stem, i), "t": _pick(TAILS, "tail", stem, i)} if where == "path" else {}
            out["https://" + (host + path).format(**values)] = (1, stem)
    for i in range(per_stem * len(UNWANTED) * 3 // 2):
        stem = _plain_word("stem", i)
        values = parts(stem, i, 0)
        if _pick(range(12), "pushes", i) == 0:  # plain urls that push
            values["b"] = values["k"]
        url = "https://" + (_pick(_GOOD_HOSTS, "host", i) + _pick([*_GOOD_PATHS, *_ANY_PATHS], "path", i)).format(**values)
        out.setdefault(url, (0, stem))
    return [(url, *told) for url, told in out.items()]


BUCKETS = 1 << 14
NGRAMS = (3, 4)
#: Labelled rows used at most; the table is meant to be small, and a larger one is sampled by the hash of its url.
MAX_LABELLED = 20_000


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: the host after the first :// up to / ? # or the end, A-Z lower-cased; the path then up to ? or #
    or the end. Both empty for null and for urls without ://."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "(?s)^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):  # the longest comes last and goes on top
        name, _, prefix = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{prefix}"))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _grams(host: Column, path: Column, buckets: int, ngrams: tuple[int, ...]) -> Column:
    """Buckets of the distinct character n-grams of host and of path, each with its own marks at both ends."""

    def gram(mark: str, text: Column, n: int):
        return lambda i: F.pmod(F.xxhash64(F.lit(mark), F.substring(text, i, F.lit(n))), F.lit(buckets)).cast("int")

    found = []
    for mark, part in (("h", host), ("p", path)):
        text = F.concat(F.lit("\x02"), part, F.lit("\x03"))
        for n in ngrams:
            places = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
            found.append(F.transform(places, gram(mark, text, n)))
    return F.array_distinct(F.concat(*found))


def _weights_column(weights: list[float]) -> Column:
    """The weights as one constant array: their number is the parameter `buckets`, whatever the data."""
    text = ",".join(repr(round(w, 9)) for w in weights)
    return F.split(F.lit(text), ",").cast("array<double>")


def _margin(grams: Column, weights: list[float], bias: float) -> Column:
    """Features of a row have norm one: each of its n-grams counts 1 / sqrt(their number)."""
    table = _weights_column(weights)
    total = F.aggregate(grams, F.lit(0.0), lambda s, i: s + F.get(table, i))
    return F.lit(bias) + total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))


def train(labelled: DataFrame, buckets: int = BUCKETS, ngrams: tuple[int, ...] = NGRAMS, rounds: int = 25, rate: float = 1.0, l2: float = 1e-6, max_rows: int = MAX_LABELLED) -> tuple[list[float], float, float]:
    """Weights, bias and threshold of a logistic regression over a small table (url, label 0 or 1), by full gradient steps
    whose rate falls in each bucket with the gradients seen there. A quarter of the hosts is left out of the steps; the
    threshold is what tells its labels best, a wrong block counting more than a miss (F 0.5).

    Rows with null urls or labels are left out. Every step is one grouped sum of gradients by bucket; at most `buckets`
    sums come back. An empty table, or one of a single class, gives zero weights and 0.5."""
    host, path = url_parts(F.col("url"))
    rows = labelled.filter("url is not null and label is not null").orderBy(F.xxhash64("url"), "url").limit(max_rows)
    rows = rows.select(_grams(host, path, buckets, ngrams).alias("grams"), F.col("label").cast("double").alias("y"), (F.crc32(host.cast("binary")) % 4 == 0).alias("out"))
    rows, where = cut(rows.coalesce(1), "labelled")  # max_rows at most: one task takes a step without a shuffle
    rows = rows.coalesce(1)
    use = rows.filter("not out")
    n, ones = use.agg(F.count("*"), F.sum("y")).first()
    weights, squares = [0.0] * (buckets + 1), [0.0] * (buckets + 1)  # the last is the bias
    threshold = 0.5
    if n and 0 < ones < n:
        for _ in range(rounds):
            error = 1 / (1 + F.exp(-_margin(F.col("grams"), weights[:-1], weights[-1]))) - F.col("y")
            each = use.select(error.alias("e"), "grams", F.sqrt(F.size("grams").cast("double")).alias("norm"))  # by itself: once a row, not once a gram
            each = each.select("e", "norm", F.explode(F.concat("grams", F.array(F.lit(buckets)))).alias("bucket"))
            share = F.when(F.col("bucket") == buckets, F.col("e")).otherwise(F.col("e") / F.col("norm"))
            for bucket, total in each.groupBy("bucket").agg(F.sum(share)).collect():
                gradient = total / n + (l2 * weights[bucket] if bucket < buckets else 0.0)
                squares[bucket] += gradient * gradient
                weights[bucket] -= rate * gradient / (squares[bucket] ** 0.5 + 1e-12)
        threshold = _best_threshold(rows.filter("out"), weights[:-1], weights[-1])
    remove(labelled.sparkSession, where)
    return weights[:-1], weights[-1], threshold


def _best_threshold(rows: DataFrame, weights: list[float], bias: float) -> float:
    """The middle of the thresholds with the best F 0.5."""
    rows = rows.select("y", (1 / (1 + F.exp(-_margin(F.col("grams"), weights, bias)))).alias("score"))
    score = F.col("score")
    steps = [i / 40 for i in range(8, 37)]
    counts = [F.sum(F.when(score >= t, F.col("y"))).alias(f"t{i}") for i, t in enumerate(steps)] + [F.count(F.when(score >= t, 1)).alias(f"b{i}") for i, t in enumerate(steps)]
    found = rows.agg(F.sum("y").alias("ones"), *counts).first()
    if not found.ones:
        return 0.5
    quality = [1.25 * (found[f"t{i}"] or 0) / (found[f"b{i}"] + 0.25 * found.ones) for i in range(len(steps))]
    best = [t for t, q in zip(steps, quality) if q == max(quality)]
    return sum(best) / len(best)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label, stem) of `labelled_rows`."""
    return spark.createDataFrame(labelled_rows(), "url string, label int, stem string")


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", threshold: float | None = None, **training) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row: the longest rule's verdict where one fits, otherwise
    block if the model's probability reaches the threshold (that of the training unless given).

    Null urls and urls without :// have empty host and path and are judged like any other; repeated rows and null ids
    stay; other columns are ignored; an empty table gives an empty result."""
    weights, bias, best = train(labelled, **training)
    threshold = best if threshold is None else threshold
    buckets, ngrams = len(weights), training.get("ngrams", NGRAMS)
    host, path = url_parts(F.col("url"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    score = 1 / (1 + F.exp(-_margin(_grams(F.col("host"), F.col("path"), buckets, ngrams), weights, bias)))
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), score.alias("score"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), F.round("score", 6).alias("score"))

