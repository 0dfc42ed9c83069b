"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams, trained with FTRL-proximal."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.shared import cut, doc_bucket, slices

NGRAMS = (1, 2, 3)
BUCKETS = 1 << 15
#: Labelled documents per language that the classifier is fitted on, at most. Document frequencies cover all of them.
FIT_ROWS = 400
#: Different labels at most, so that the weights fit a task (67 MB at 256 labels, three times while fitting); tables
#: with more are refused with an error, as these are no languages.
MAX_LANGS = 256
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def gram_counts(text: str, buckets: int = BUCKETS, ngrams: tuple[int, ...] = NGRAMS) -> np.ndarray:
    """How often each bucket of hashed character n-grams of the whole lower-cased text occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = 32 - (buckets.bit_length() - 1)
    counts = np.zeros(buckets, np.int64)
    for n in ngrams:
        if len(codes) < n:
            continue
        h = np.full(len(codes) - n + 1, n, np.uint32)
        for i in range(n):
            h = (h ^ codes[i : len(codes) - n + 1 + i]) * _MULTIPLIERS[i % 4]
            h ^= h >> np.uint32(15)
        counts += np.bincount((h * np.uint32(0x9E3779B1)) >> np.uint32(shift), minlength=buckets)
    return counts


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _frequencies(buckets: int, ngrams: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(buckets, np.int64), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                df += gram_counts(text, buckets, ngrams) > 0
                n += 1
        at = np.flatnonzero(df)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[n, df[at]], pa.int64())], ["bucket", "n"])

    return run


def _features(idf: np.ndarray, ngrams: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                index, value = [], []
                for text in batch.column(2).to_pylist():
                    x = gram_counts(text, len(idf), ngrams) * idf
                    at_ = np.flatnonzero(x)
                    index.append(at_.astype(np.int32)), value.append((x[at_] / max(np.sqrt((x**2).sum()), 1e-12)).astype(np.float32))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))], ["lang", "order", "index", "value"])

    return run


def fit_ftrl(index: list[np.ndarray], value: list[np.ndarray], label: np.ndarray, classes: int, buckets: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.01, l2: float = 0.01, epochs: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Weights (buckets + 1, classes), the last row being the bias, by follow-the-regularised-leader steps with
    per-coordinate rates and elastic-net penalties; most weights end at zero."""
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))

    def weights(at):
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    for _ in range(epochs):
        for i, v, y in zip(index, value, label):
            at, x = np.append(i, buckets), np.append(v, 0.1)
            w = weights(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            old = n[at]
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / alpha * w
            n[at] = old + g * g
    return weights(np.arange(buckets + 1))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least cross-entropy on held-back rows, their targets smoothed by 1 / (n + 2)."""
    n, classes = logits.shape
    if not n:
        return 1.0
    target = np.full((n, classes), 1 / (n + 2) / classes)
    target[np.arange(n), label] += 1 - 1 / (n + 2)

    def loss(log_t):
        p = softmax(logits / np.exp(log_t))
        return -(target * np.log(np.maximum(p, 1e-300))).sum()

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float
    ngrams: tuple[int, ...]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        x = gram_counts(text, len(self.idf), self.ngrams) * self.idf
        norm = max(float(np.sqrt(x @ x)), 1e-12)
        p = softmax((x @ self.weights[:-1] / norm + 0.1 * self.weights[-1]) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def train(labelled: DataFrame, buckets: int = BUCKETS, ngrams: tuple[int, ...] = NGRAMS, fit_rows: int = FIT_ROWS) -> Model:
    """Fits a model on (doc_id, text, lang); rows with null text or lang are left out.

    Document frequencies come from all rows. The classifier is fitted on at most fit_rows different documents of each
    language, drawn by a hash of id and text, so that ids that many documents share, or none, leave none out; a fifth of
    them is kept back for the temperature; whole texts throughout. Over MAX_LANGS labels are an error."""
    rows = labelled.filter("text is not null and lang is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    found = rows.select("text").mapInArrow(_frequencies(buckets, ngrams), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # one row per bucket at most
    counts = {r.bucket: r.n for r in found}
    total = counts.pop(-1, 0)
    idf = np.full(buckets, np.log(1 + total), np.float64)
    idf[list(counts)] = [np.log((1 + total) / (1 + n)) for n in counts.values()]
    idf += 1
    rows = rows.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text", F.lit("fit")), F.lit(1 << 52)))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("draw").alias("size")).limit(MAX_LANGS + 1).collect()
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"over {MAX_LANGS} different labels: these are no languages")
    sizes = labelled.sparkSession.createDataFrame(sizes, "lang string, size long")
    sample = draw_sample(rows, sizes, fit_rows)
    features = sample.mapInArrow(_features(idf, ngrams), "lang string, order int, index array<int>, value array<float>")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "lang"])
        langs = sorted(pdf["lang"].unique())
        label = pdf["lang"].map(langs.index).to_numpy()
        index, value = list(pdf["index"]), list(pdf["value"])
        back = (pdf["order"] % 5 == 0).to_numpy()
        use = np.flatnonzero(~back)
        w = fit_ftrl([index[i] for i in use], [value[i] for i in use], label[use], len(langs), buckets)
        logits = np.array([value[i] @ w[index[i]] + 0.1 * w[-1] for i in np.flatnonzero(back)]).reshape(-1, len(langs))
        t = fit_temperature(logits, label[back])
        return pd.DataFrame({"lang": langs, "temperature": t, "weights": list(w.T)})

    made = features.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(fit, "lang string, temperature double, weights array<double>").collect() if total else []
    made.sort(key=lambda r: r.lang)
    weights = np.array([r.weights for r in made]).T if made else np.zeros((buckets + 1, 0))
    return Model([r.lang for r in made], idf, weights, made[0].temperature if made else 1.0, ngrams)


def draw_sample(rows: DataFrame, sizes: DataFrame, fit_rows: int) -> DataFrame:
    """(lang, order, text): the fit_rows different documents of the smallest draws of each language. Before they are
    sorted, draws that are too large beyond doubt go (rows: with a column draw; sizes: how many draws each has, about)."""
    most = (1.5 * fit_rows + 50) * (1 << 52) / F.greatest(F.col("size"), F.lit(1))
    drawn = rows.join(F.broadcast(sizes), "lang").filter(F.col("draw") < most).dropDuplicates(["lang", "draw"])  # MAX_LANGS rows
    order = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    return drawn.select("lang", "draw", "text").withColumn("order", order).filter(F.col("order") <= fit_rows).select("lang", "order", "text")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from the text alone: the language of the highest probability, and that
    probability after calibration. Null texts, and texts without a letter, are `und` with score 0, as is everything
    under a model without languages. Rows that repeat or have a null id get a result each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [shared.value.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return doc_bucket(doc_id, folds) == fold


def language_of_documents(docs: DataFrame, **training) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): trained on the documents that are not held out, predicted for all."""
    model = train(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), **training)
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float, **training) -> DataFrame:
    """docs, columns as they are, without the rows whose language is `und` or has a score under `least`. Every row is
    judged by its own text, whatever its id; the model is that of language_of_documents."""
    model = train(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), **training)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [shared.value.predict(t) for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in made], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
