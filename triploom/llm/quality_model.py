"""Quality classifier by co-training: a text view and a metadata view teach
each other, and their calibrated scores are combined.

The text view sees shares and averages of the text alone (symbols, tables,
capitals, digits, repetition, word and sentence lengths); the metadata view
sees source, language and length, the first two as label rates over all
labelled rows (a labelled row's own label left out). Both are logistic
regressions. They start from a bounded sample of labelled rows; in each
round either view scores every unlabelled document, and the documents that
it is most sure of, at most ``pseudo`` a class and round, get its label and
join the other view's training rows. At the end the two views' log-odds are
combined by a logistic regression on labelled rows that no view was trained
on, which calibrates the sum, and every document is scored.

Statistics and scores are DataFrame expressions over the whole table; what
reaches the driver is the feature rows of the bounded samples.

Defined results: null and empty texts have zero statistics; null metadata
are values of their own; several labels of a document count by their mean;
null labels are none; without labels of both classes every document gets
the label share (0.5 without labels); repeated rows are rows; an empty table
gives no rows; further columns are kept, but for those named like results (``_c_`` names are
reserved).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.llm.words import SPACES, let, split_words
from triploom.session import materialize

SAMPLE_ROWS = 12_000     # labelled rows that views are fitted on
CALIBRATION_ROWS = 6_000  # labelled rows that only the combination sees
ROUNDS = 3
PSEUDO = 1000            # pseudo-labels a view gives per class and round
SURE = 0.97              # least probability of a pseudo-label
PENALTY = 1e-2
KEEP = 0.5
MAX_BROADCAST_GROUPS = 100_000

RESULTS = ("text_score", "meta_score", "score", "kept")
TEXT = ("word_length", "symbols", "bars", "upper", "digits", "stops", "variety", "repeats",
        "lines", "dup_lines", "shouts", "other")
META = ("source", "lang", "length", "length2")


def _text_view(text: Column) -> dict[str, Column]:
    words, chars = F.col("_c_words"), F.greatest(F.length(text), F.lit(1)).cast("double")
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    share = lambda pattern: F.sqrt(F.regexp_count(text, F.lit(pattern)) / chars)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S"))
    n_lines = F.greatest(F.size(lines), F.lit(1)).cast("double")
    again = F.size(F.filter(F.zip_with(words, F.slice(words, 2, F.size(words)),
                                       lambda a, b: F.coalesce(a == b, F.lit(False))),
                            lambda same: same))
    return {
        "word_length": F.log1p(F.length(F.array_join(words, "")) / n),
        "symbols": share("[#*$%&<>^~=@]"), "bars": share("[|]"), "upper": share("[A-Z]"),
        "digits": share("[0-9]"), "stops": share("[.,]"), "shouts": share("[!?]"),
        "variety": F.size(F.array_distinct(words)) / n ** 0.9,
        "repeats": F.sqrt(again / n), "lines": F.log1p(n_lines / n * 100),
        "dup_lines": let(lines, lambda x: F.sqrt(
            (F.size(x) - F.size(F.array_distinct(x))) / n_lines)),
        "other": F.sqrt(F.greatest(F.octet_length(text) - F.length(text), F.lit(0)) / chars),
    }


def measure(docs: DataFrame, labels: DataFrame, text_col: str, id_col: str, lang_col: str,
            source_col: str, chars_col: str, label_col: str, carry: list[str]) -> DataFrame:
    """Stored rows: carry, _c_key, _c_t_* (text view), metadata, _c_label."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.withColumn("_c_words", split_words(text, SPACES))
    rows = rows.withColumns({f"_c_t_{k}": v for k, v in _text_view(text).items()})
    n_chars = F.log1p(F.greatest(F.coalesce(F.col(chars_col).cast("double"), F.lit(0.0)),
                                 F.lit(0.0)))
    rows = rows.withColumns({
        "_c_key": F.col(id_col), "_c_source": F.coalesce(F.col(source_col).cast("string"),
                                                         F.lit("\x00")),
        "_c_lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("\x00")),
        "_c_m_length": n_chars, "_c_m_length2": n_chars * n_chars})
    kept = list(dict.fromkeys(carry + ["_c_key", "_c_source", "_c_lang", "_c_m_length",
                                       "_c_m_length2"] + [f"_c_t_{k}" for k in TEXT]))
    rows = materialize(rows.select(*kept), "quality-rows")
    label = labels.filter(F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("_c_label_id")).agg(
        (F.avg(label_col) >= 0.5).cast("int").alias("_c_label"))
    rows = rows.join(label, F.col("_c_key") == F.col("_c_label_id"), "left").drop("_c_label_id")
    for name in ("source", "lang"):
        rows = _label_rates(rows, name)
    return materialize(rows, "quality-rows")


def _label_rates(rows: DataFrame, name: str, prior: float = 20.0) -> DataFrame:
    """_c_m_<name>: log-odds of the label in the row's group, drawn towards
    the overall share, without the row's own label."""
    group = f"_c_{name}"
    labelled = rows.filter("_c_label is not null")
    n, yes = labelled.agg(F.count(F.lit(1)), F.sum("_c_label")).first()
    share = ((yes or 0) + 1) / (n + 2)
    rates = labelled.groupBy(group).agg(F.count(F.lit(1)).alias("_c_n"),
                                        F.sum("_c_label").alias("_c_yes"))
    rates = materialize(rates, "label-rates")
    if rates.count() <= MAX_BROADCAST_GROUPS:
        rows = rows.join(F.broadcast(rates), group, "left")
    else:
        salted = rates.withColumn("_c_salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        rows = rows.withColumn("_c_salt", F.pmod(F.xxhash64("_c_key"), F.lit(64)).cast("int")) \
            .join(salted, [group, "_c_salt"], "left").drop("_c_salt")
    own = F.coalesce(F.col("_c_label"), F.lit(0))
    n = F.coalesce("_c_n", F.lit(0)) - F.when(F.col("_c_label").isNull(), 0).otherwise(1)
    yes = F.coalesce("_c_yes", F.lit(0)) - own
    p = (yes + prior * share) / (n + prior)
    return rows.withColumn(f"_c_m_{name}", F.log(p / (1 - p))).drop("_c_n", "_c_yes")


class Logistic:
    """Logistic regression on standardised columns, by Newton steps."""

    def __init__(self, columns: list[str], x: np.ndarray, y: np.ndarray):
        self.columns = columns
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        w = np.zeros(z.shape[1])
        ridge = np.full(len(w), PENALTY * len(x))
        ridge[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(h, z.T @ (p - y) + ridge * w)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.weights, self.bias = w[:-1] / self.scale, w[-1] - (w[:-1] / self.scale) @ self.mean

    def odds(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def column(self) -> Column:
        """The log-odds as an expression."""
        out = F.lit(float(self.bias))
        for name, w in zip(self.columns, self.weights):
            out = out + F.col(name) * float(w)
        return out


def _rows(df: DataFrame, columns: list[str]) -> np.ndarray:
    got = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).toPandas()
    return got.to_numpy(float)


def train(rows: DataFrame, sample_rows: int = SAMPLE_ROWS,
          calibration_rows: int = CALIBRATION_ROWS, rounds: int = ROUNDS,
          pseudo: int = PSEUDO, sure: float = SURE):
    """(text view, metadata view, combination) from measured rows; None if
    the labels lack a class."""
    views = ([f"_c_t_{k}" for k in TEXT], [f"_c_m_{k}" for k in META])
    columns = views[0] + views[1] + ["_c_label"]
    draw = F.xxhash64(F.lit("quality"), F.col("_c_key"))
    labelled = rows.filter("_c_label is not null").withColumn("_c_draw", draw)
    total = labelled.count()
    # samples by ranges of the hash, then bounded
    upto = lambda n: min(-2**63 + int(2**64 * min(1.0, n / max(total, 1))),
                         2**63 - 1)
    if total <= sample_rows + calibration_rows:
        sample_rows, calibration_rows = -(-total * 2 // 3), total // 3
    cut = upto(sample_rows)
    end = upto(sample_rows + calibration_rows)
    fit = _rows(labelled.filter(F.col("_c_draw") < cut).limit(2 * sample_rows + 1), columns)
    held = _rows(labelled.filter((F.col("_c_draw") >= cut) & (F.col("_c_draw") <= end))
                 .limit(2 * calibration_rows + 1), columns)
    both = lambda a: len(a) and 0 < a[:, -1].sum() < len(a)
    if not both(fit) or not both(held):
        return None
    at = (slice(0, len(TEXT)), slice(len(TEXT), len(TEXT) + len(META)))
    taught = [fit, fit]
    models = [Logistic(v, t[:, a], t[:, -1]) for v, t, a in zip(views, taught, at)]
    unlabelled = rows.filter("_c_label is null")
    line = float(np.log(sure / (1 - sure)))
    share = min(1.0, 2 * pseudo / max(unlabelled.count(), 1) + 2e-4)
    given: set = set()
    for _ in range(rounds):
        news = []
        for m in models:
            odds = unlabelled.withColumn("_c_odds", m.column())
            # where the surest end on either side, from a mergeable quantile:
            # only about twice as many rows as wanted are sorted
            high, low = odds.agg(*[F.percentile_approx(
                F.col("_c_odds") * s, 1 - share, 10_000) for s in (1, -1)]).first()
            picks = [odds.filter(F.col("_c_odds") * s >= max(line, end or line))
                     .orderBy(F.desc(F.col("_c_odds") * s), draw).limit(pseudo)
                     .withColumn("_c_label", F.lit(int(s > 0)))
                     for s, end in ((1, high), (-1, low))]
            news.append(_rows(picks[0].unionByName(picks[1]), columns))
        # what a view is sure of teaches the other
        taught = [np.concatenate([fit, news[1]]), np.concatenate([fit, news[0]])]
        models = [Logistic(v, t[:, a], t[:, -1]) for v, t, a in zip(views, taught, at)]
        now = {x.tobytes() for x in np.concatenate(news)}
        if now == given:
            break
        given = now
    odds = np.column_stack([m.odds(held[:, a]) for m, a in zip(models, at)])
    return models[0], models[1], Logistic(["_c_text_odds", "_c_meta_odds"], odds, held[:, -1])


def score_documents(docs: DataFrame, labels: DataFrame, text_col: str = "text",
                    id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source",
                    chars_col: str = "n_chars", label_col: str = "quality",
                    carry: list[str] | None = None, keep: float = KEEP, **options) -> DataFrame:
    """The ``carry`` columns (all by default) of every row with text_score,
    meta_score, score (0 to 1) and kept (score at least ``keep``)."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    rows = measure(docs, labels, text_col, id_col, lang_col, source_col, chars_col,
                   label_col, carry)
    models = train(rows, **options)
    sigmoid = lambda c: 1 / (1 + F.exp(-F.greatest(F.lit(-50.0), c)))
    if models is None:
        n, yes = rows.agg(F.count("_c_label"), F.sum("_c_label")).first()
        share = ((yes or 0) + 1) / (n + 2)
        out = rows.withColumns({"text_score": F.lit(share), "meta_score": F.lit(share),
                                "score": F.lit(share)})
    else:
        out = rows.withColumns({"_c_text_odds": models[0].column(),
                                "_c_meta_odds": models[1].column()})
        out = out.withColumns({"text_score": sigmoid(F.col("_c_text_odds")),
                               "meta_score": sigmoid(F.col("_c_meta_odds")),
                               "score": sigmoid(models[2].column())})
    return out.withColumn("kept", F.col("score") >= keep).select(
        *carry, *RESULTS)
