"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader.

Texts are lower-cased, everything but letters becomes one space, and the
1- to 3-grams of characters are hashed to ``BUCKETS`` features. Document
frequencies for the IDF weights are counted over every training document.
The weights are fitted on a bounded sample of labelled documents (at most
``sample_docs``, an equal share per language, drawn by a hash of the id) with
per-coordinate follow-the-regularised-leader steps and elastic-net
penalties, so most weights are exactly zero. A temperature, fitted on a part
of the sample that the weights haven't seen, calibrates the probabilities.

Only counted features (at most ``BUCKETS`` a document) of the sample reach
the driver; scoring runs on whole texts in the tasks.

Defined results: null texts and texts without a letter are ``und`` with
score 0; labels that are null, and texts without a letter, aren't learned
from; without any label all are ``und``; with one label every text with a
letter gets it; repeated rows are rows; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
ORDERS = 3
SAMPLE_DOCS = 4000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
CALIBRATION_SHARE = 0.2
UNKNOWN = "und"

_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code point and letter flag of every code point."""
    if not _TABLES:
        lower = np.arange(0x110000, dtype=np.uint32)
        letter = np.zeros(0x110000, bool)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                letter[i] = True
                low = c.lower()
                if len(low) == 1:
                    lower[i] = ord(low)
        _TABLES.extend([lower, letter])
    return _TABLES[0], _TABLES[1]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(features, counts) of a text; none if it has no letter."""
    none = np.empty(0, np.int64), np.empty(0, np.float64)
    if not text:
        return none
    lower, letter = _tables()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[codes]
    if not is_letter.any():
        return none
    codes = np.where(is_letter, lower[codes], 32)
    keep = np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
    grams, found = codes, []
    for order in range(1, ORDERS + 1):
        if order > 1:
            grams = grams[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[order - 1:]
        mixed = (grams + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)
        found.append((mixed >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64))
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at].astype(np.float64)


def _weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / np.sqrt((x * x).sum())


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    idf: np.ndarray        # BUCKETS
    weights: np.ndarray    # BUCKETS + 1 (bias) by labels
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        at, counts = ngram_counts(text)
        if not len(at) or not self.labels:
            return UNKNOWN, 0.0
        scores = _weighted(at, counts, self.idf) @ self.weights[at] + self.weights[-1]
        p = _softmax(scores / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(p[k])


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int,
               epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights (with a bias row at the end, which isn't penalised)."""
    z = np.zeros((BUCKETS + 1, n_labels))
    n = np.zeros_like(z)
    l1, l2 = np.full(BUCKETS + 1, L1), np.full(BUCKETS + 1, L2)
    l1[-1] = l2[-1] = 0

    def weights(at):
        rate = (BETA + np.sqrt(n[at])) / ALPHA + l2[at, None]
        return -np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at, None], 0) / rate

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[labels[k]] -= 1
            g = x[:, None] * error
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log-likelihood."""
    if not len(scores):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 80))
    loss = [-np.log(np.maximum(_softmax(scores / t)[np.arange(len(labels)), labels], 1e-12))
            .mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Fit on labelled ``docs``."""
    docs = docs.select(F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang"),
                       F.col(id_col).alias("id")).filter("lang is not null")
    share = {r["lang"]: r["count"] for r in docs.groupBy("lang").count().collect()}
    none = LanguageModel([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0)
    if not share:
        return none

    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b["text"]:
                at, _ = ngram_counts(t)
                df[at] += 1
                n += len(at) > 0
        at = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(df[at], n)})

    counted = docs.select("text").mapInPandas(frequencies, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = int(counted.loc[counted["bucket"] < 0, "n"].sum())
    counted = counted[counted["bucket"] >= 0]
    df = np.zeros(BUCKETS)
    df[counted["bucket"]] = counted["n"]
    idf = np.log((1 + total) / (1 + df)) + 1

    # an equal share of the sample for every language, by a hash of the id
    each = sample_docs / len(share)
    quota = F.create_map(*[F.lit(x) for k, v in share.items()
                           for x in (k, float(min(1.0, each / v)))])
    drawn = docs.withColumn("draw", F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 1_000_003.0) \
        .filter(F.col("draw") < F.element_at(quota, F.col("lang"))).limit(2 * sample_docs)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [ngram_counts(t) for t in b["text"]]
            yield pd.DataFrame({"lang": b["lang"], "draw": b["draw"],
                                "at": [a.astype(np.int32) for a, _ in got],
                                "n": [c.astype(np.int32) for _, c in got]})

    sample = drawn.select("text", "lang", "draw").mapInPandas(
        features, "lang string, draw double, at array<int>, n array<int>").toPandas()
    sample = sample[sample["at"].map(len) > 0].sort_values(["draw", "lang"])
    labels = sorted(sample["lang"].unique())
    if not labels:
        return none
    y = sample["lang"].map(labels.index).to_numpy()
    rows = [(np.asarray(a, np.int64), _weighted(np.asarray(a, np.int64),
                                                np.asarray(c, np.float64), idf))
            for a, c in zip(sample["at"], sample["n"])]
    # every fifth drawn document calibrates
    held = np.arange(len(rows)) % round(1 / CALIBRATION_SHARE) == 0
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(rows))
    w = train_ftrl([rows[k] for k in fit], y[fit], len(labels))
    held = np.flatnonzero(held)
    scores = np.array([rows[k][1] @ w[rows[k][0]] + w[-1] for k in held])
    return LanguageModel(labels, idf, w, fit_temperature(scores, y[held]))


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1), from the text alone. The
    model is a fixed number of weights per language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("_l", predict(F.col(text_col).cast("string"))).withColumns(
        {"lang_pred": F.col("_l.lang_pred"), "score": F.col("_l.score")}).drop("_l")


def fold(id_col: str = "doc_id", folds: int = 3) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
