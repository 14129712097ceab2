"""Quality rules: text statistics, base rules and robust outlier rejection.

Every document gets word, symbol, line and repetition statistics. The base
rules reject very short and very repetitive texts. Of the rest, a vector of
transformed statistics is compared with its language and source: the
minimum-covariance-determinant estimate of each group (center and scatter
of the half of its documents that lie closest together) gives a
Mahalanobis distance, and a document far outside is rejected.

The estimate runs as concentration steps over a stored table of vectors:
from medians and median deviations, each step takes the nearer half of
every group (by a mergeable quantile of the distances) and re-estimates
mean and scatter from sums of products, which are pre-aggregated before the
shuffle, so a group with a third of all rows costs no single task. The
deviations of short texts, whose statistics vary more, weigh less, in the
estimate and in the verdict alike. A statistic that is zero in most
documents has no scatter in the nearer half; there, the spread of all groups
together counts, taken a second time without the documents that the first
estimate finds far outside. Groups
with fewer than ``min_group`` documents are pooled by language, then over
all; a pool that stays smaller rejects nothing.

Defined results: null and empty texts have no words and fail the base
rules; null languages and sources form groups of their own; repeated rows
are rows; an empty table gives no rows; further columns are kept by
:func:`filter_documents` (names starting with ``_q_`` are reserved). Only
DataFrame functions are used.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.llm.words import SPACES, let, split_words
from triploom.session import materialize

WINDOW = 8              # words of a repeated window
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MIN_GROUP = 60          # documents a group needs for an estimate of its own
STEPS = 3               # concentration steps
SHORT = 100             # deviations of texts with fewer words weigh least
# Fixed value of the chi-square distribution with six degrees of freedom.
CHI2_MEDIAN = 5.348
# Squared distances beyond which a document is left out of the second
# estimate of the spreads, and rejected; between the labelled good and bad
# documents (see README).
FIRST_CUT = 70.0
CUT = 200.0
VECTOR = ("length", "variety", "symbols", "repeats", "upper", "digits")
# Least spreads: a share of all groups' spread, and a numerical one. Least
# consistency factor, for groups made of copies.
LEAST_SHARE, LEAST_SPREAD, LEAST_SCALE = 0.5, 0.005, 0.5
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _window_hashes(words: Column) -> Column:
    """64-bit hashes of all 8-word windows, by doubling: a word's hash, then
    hashes of 2, 4 and 8 words."""
    def double(h: Column, step: int) -> Column:
        return let(h, lambda x: F.zip_with(x, F.slice(x, step + 1, F.size(x)),
                                           lambda a, b: F.xxhash64(a, b)))

    h = F.transform(words, lambda w: F.xxhash64(w))
    for step in (1, 2, 4):
        h = double(h, step)
    return let(h, lambda x: F.slice(x, 1, F.greatest(F.size(x) - (WINDOW - 1), F.lit(0))))


def _repeated_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs more than once."""
    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        places = let(ranked, lambda r: F.sort_array(F.transform(F.filter(
            r, lambda x, i: (F.get(r, i - 1)["h"] == x["h"]) | (F.get(r, i + 1)["h"] == x["h"])),
            lambda x: x["i"])))
        return let(places, lambda p: F.aggregate(
            F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(
                F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda s, x: s + x))

    return let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h)))


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base statistics and further counts, as _q_ columns."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumn("_q_words", split_words(text, SPACES))
    measured = out.withColumns({
        "_q_n_words": F.size("_q_words").cast("long"),
        "_q_word_chars": F.length(F.array_join("_q_words", "")).cast("long"),
        "_q_n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "_q_n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        .cast("long"),
        "_q_n_repeat_words": _repeated_words(_window_hashes(F.col("_q_words"))),
        "_q_n_upper": F.regexp_count(text, F.lit(r"[A-Z]")).cast("long"),
        "_q_n_digits": F.regexp_count(text, F.lit(r"[0-9]")).cast("long"),
        "_q_n_distinct": F.size(F.array_distinct("_q_words")).cast("long"),
    })
    return measured.drop("_q_words")


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def vector() -> dict[str, Column]:
    """The transformed statistics of a measured row."""
    c = lambda n: F.col(f"_q_{n}").cast("double")
    chars = F.greatest(c("word_chars"), F.lit(1.0))
    words = F.greatest(c("n_words"), F.lit(1.0))
    return {
        "length": F.log(chars / words),
        "variety": F.log(F.greatest(c("n_distinct"), F.lit(1.0))) / F.log(words + 1),
        "symbols": F.sqrt(c("n_symbols") / chars),
        "repeats": F.sqrt(c("n_repeat_words") / words),
        "upper": F.sqrt(c("n_upper") / chars),
        "digits": F.sqrt(c("n_digits") / chars),
    }


def _joined(rows: DataFrame, table: DataFrame, key: str, n_groups: int,
            max_broadcast_groups: int = 100_000, salts: int = 64) -> DataFrame:
    """Rows with their group's columns: broadcast for few groups, else a
    join whose keys are salted so that a hot group is spread."""
    if n_groups <= max_broadcast_groups:
        return rows.join(F.broadcast(table), key, "left")
    salted = table.withColumn("_q_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (rows.withColumn("_q_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts))
                            .cast("int"))
            .join(salted, [key, "_q_salt"], "left").drop("_q_salt"))


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """(lang, source) with the key of the group or pool it is estimated in."""
    n = rows.groupBy("_q_lang", "_q_source").agg(F.count(F.lit(1)).alias("n"))
    by_lang = n.filter(F.col("n") < min_group).groupBy("_q_lang").agg(F.sum("n").alias("pool"))
    out = n.join(by_lang, "_q_lang", "left")
    return out.select("_q_lang", "_q_source", F.when(
        F.col("n") >= min_group, F.concat_ws("\x1f", F.lit("s"), "_q_lang", "_q_source"))
        .when(F.col("pool") >= min_group, F.concat_ws("\x1f", F.lit("l"), "_q_lang"))
        .otherwise(F.lit("all")).alias("_q_group"))


def _weight() -> Column:
    """What a document's deviations count, by its words."""
    words = F.col("_q_n_words").cast("double")
    return F.sqrt(words / (words + SHORT))


def _deviations(names: list[str]) -> list[Column]:
    return [(F.col(a) - F.col(f"m_{i}")) * _weight() for i, a in enumerate(names)]


def _distance(rows: DataFrame, names: list[str]) -> DataFrame:
    """_q_d2 from the group's center (m_i) and its scatter, factored as
    L D L' (l_i_j, d_i): residuals are taken off coordinate by coordinate."""
    for i, z in enumerate(_deviations(names)):
        for j in range(i):
            z = z - F.col(f"l_{i}_{j}") * F.col(f"z_{j}")
        rows = rows.withColumn(f"z_{i}", z)
    d2 = sum(F.col(f"z_{i}") * F.col(f"z_{i}") / F.col(f"d_{i}") for i in range(len(names)))
    return rows.withColumn("_q_d2", d2).drop(*[f"z_{i}" for i in range(len(names))])


def _factored(cov: DataFrame, names: list[str], least: list[float]) -> DataFrame:
    """Group rows with s_i_j turned into the L D L' factors, one coordinate
    a projection."""
    k = len(names)
    for i in range(k):
        for j in range(i):
            v = F.col(f"s_{i}_{j}")
            for t in range(j):
                v = v - F.col(f"l_{i}_{t}") * F.col(f"l_{j}_{t}") * F.col(f"d_{t}")
            cov = cov.withColumn(f"l_{i}_{j}", v / F.col(f"d_{j}"))
        v = F.col(f"s_{i}_{i}")
        for t in range(i):
            v = v - F.col(f"l_{i}_{t}") * F.col(f"l_{i}_{t}") * F.col(f"d_{t}")
        # the floor holds for what is left of the spread, too
        cov = cov.withColumn(f"d_{i}", F.greatest(v, F.lit(least[i] ** 2)))
    keep = ["_q_group"] + [f"m_{i}" for i in range(k)] + [f"d_{i}" for i in range(k)] + [
        f"l_{i}_{j}" for i in range(k) for j in range(i)]
    return cov.select(*keep)


def _least_spreads(rows: DataFrame, names: list[str],
                   flat: list[bool] | None = None) -> tuple[list[float], list[bool]]:
    """Per statistic, the least spread a group is taken to have, from the
    deviations of all ``rows`` from their centers, and whether more than half
    of these are zero (``flat``, if it is known): then their root mean square
    counts."""
    dev = _deviations(names)
    r = rows.agg(*[F.percentile_approx(F.abs(z), 0.5, 2000).alias(f"a_{i}")
                   for i, z in enumerate(dev)],
                 *[F.avg(z * z).alias(f"v_{i}") for i, z in enumerate(dev)]).first()
    flat = flat or [not (r[f"a_{i}"] or 0) > 1e-9 for i in range(len(names))]
    # 1.4826 times a median deviation is a standard deviation
    least = [(r[f"v_{i}"] or 0.0) ** 0.5 if flat[i] else LEAST_SHARE * 1.4826 * r[f"a_{i}"]
             for i in range(len(names))]
    return [max(x, LEAST_SPREAD) for x in least], flat


def _concentrated(rows: DataFrame, start: DataFrame, least: list[float], n_groups: int,
                  steps: int) -> DataFrame:
    """Center, factored scatter, scale and n per group, by ``steps``
    concentration steps from medians (m_i) and median deviations (a_i)."""
    names, k = list(VECTOR), len(VECTOR)
    mid = lambda c: F.percentile_approx(c, 0.5, 2000)
    zero = {f"l_{i}_{j}": F.lit(0.0) for i in range(k) for j in range(i)}
    now = start.withColumns(
        {f"d_{i}": F.greatest(F.col(f"a_{i}") * 1.4826, F.lit(least[i])) ** 2
         for i in range(k)} | zero).drop(*[f"a_{i}" for i in range(k)])
    for _ in range(steps):
        # read twice, for its median and for the near half
        far = materialize(_distance(_joined(rows, now, "_q_group", n_groups), names).select(
            "_q_group", "_q_d2", *names, *[z.alias(f"r_{i}") for i, z in
                                           enumerate(_deviations(names))]), "mcd-far")
        half = far.groupBy("_q_group").agg(mid(F.col("_q_d2")).alias("_q_half"))
        near = _joined(far, half, "_q_group", n_groups).filter(F.col("_q_d2") <= F.col("_q_half"))
        pairs = list(itertools.combinations_with_replacement(range(k), 2))
        cov = near.groupBy("_q_group").agg(
            *[F.avg(a).alias(f"m_{i}") for i, a in enumerate(names)],
            *[F.covar_pop(f"r_{j}", f"r_{i}").alias(f"s_{j}_{i}") for i, j in pairs])
        now = materialize(_factored(materialize(cov, "mcd-scatter"), names, least), "mcd")
    # the half's scatter isn't the group's: the factor that makes the median
    # distance the chi-square median corrects it
    far = _distance(_joined(rows, now, "_q_group", n_groups), names)
    scale = far.groupBy("_q_group").agg(
        F.greatest(mid(F.col("_q_d2")) / CHI2_MEDIAN, F.lit(LEAST_SCALE)).alias("scale"),
        F.count(F.lit(1)).alias("n"))
    return materialize(now.join(scale, "_q_group"), "mcd")


def mcd_estimates(rows: DataFrame, min_group: int = MIN_GROUP, steps: int = STEPS) -> DataFrame:
    """One row per group of ``rows`` (_q_group, _q_n_words and the vector's
    columns): center, factored scatter, scale and n. ``rows`` should be a
    stored table."""
    names = list(VECTOR)
    n_groups = rows.select("_q_group").distinct().count()
    mid = lambda c: F.percentile_approx(c, 0.5, 2000)
    center = rows.groupBy("_q_group").agg(
        *[mid(F.col(a)).alias(f"m_{i}") for i, a in enumerate(names)])
    spread = _joined(rows, center, "_q_group", n_groups).groupBy("_q_group").agg(
        *[mid(F.abs(z)).alias(f"a_{i}") for i, z in enumerate(_deviations(names))])
    start = materialize(center.join(spread, "_q_group"), "mcd")
    least, flat = _least_spreads(_joined(rows, start, "_q_group", n_groups), names)
    out = _concentrated(rows, start, least, n_groups, steps)
    if any(flat):
        # the documents far outside must not widen these spreads
        inside = _distance(_joined(rows, out, "_q_group", n_groups), names).filter(
            F.col("_q_d2") <= FIRST_CUT * F.col("scale"))
        again, _ = _least_spreads(inside, names, flat)
        least = [min(x, y) if f else x for x, y, f in zip(least, again, flat)]
        out = _concentrated(rows, start, least, n_groups, steps)
    return out.filter(F.col("n") >= min_group)


def _measured(docs: DataFrame, text_col: str, lang_col: str, source_col: str,
              carry: list[str]) -> DataFrame:
    """_q_carry (a struct, so that no carried name can clash), the statistics,
    _q_base_failed and the vector (_q_v_*) of every row; nothing is stored."""
    wanted = docs.withColumns({
        "_q_lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("\x00")),
        "_q_source": F.coalesce(F.col(source_col).cast("string"), F.lit("\x00"))})
    measured = text_statistics(wanted, text_col).withColumn("_q_base_failed", base_failed(
        F.col("_q_n_words"), F.col("_q_n_repeat_words")))
    measured = measured.withColumns({f"_q_v_{n}": c for n, c in vector().items()})
    stats = [c for c in measured.columns if c.startswith("_q_")]
    return measured.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_q_carry"), *stats)


def _fit(measured: DataFrame, min_group: int, steps: int) -> tuple[DataFrame, DataFrame, int]:
    """(groups by language and source, estimates, number of groups)."""
    names = list(VECTOR)
    fit = materialize(measured.filter(~F.col("_q_base_failed")).select(
        "_q_lang", "_q_source", "_q_n_words",
        *[F.col(f"_q_v_{n}").alias(n) for n in names]), "quality-fit")
    groups = materialize(_groups(fit, min_group), "quality-groups")
    n_groups = groups.count()
    pair = F.struct("_q_lang", "_q_source")
    groups = groups.select(pair.alias("_q_pair"), "_q_group")
    grouped = _joined(fit.withColumn("_q_pair", pair), groups, "_q_pair", n_groups) \
        .select("_q_group", "_q_n_words", *names)
    return groups, mcd_estimates(grouped, min_group, steps), n_groups


def _judged(measured: DataFrame, groups: DataFrame, estimates: DataFrame, n_groups: int,
            cut: float) -> DataFrame:
    """Measured rows with _q_group, _q_distance and _q_kept."""
    names, stats = list(VECTOR), [c for c in measured.columns if not c.startswith("_q_v_")]
    rows = _joined(measured.withColumn("_q_pair", F.struct("_q_lang", "_q_source")), groups,
                   "_q_pair", n_groups)
    rows = rows.withColumns({n: F.col(f"_q_v_{n}") for n in names})
    far = _distance(_joined(rows, estimates, "_q_group", n_groups), names)
    distance = F.when(~F.col("_q_base_failed"), F.col("_q_d2") / F.col("scale"))
    return far.withColumn("_q_distance", distance).select(
        *stats, "_q_group", "_q_distance",
        (~F.col("_q_base_failed") & (F.coalesce(F.col("_q_distance"), F.lit(0.0)) <= cut))
        .alias("_q_kept"))


def _carried(columns: list[str]) -> list[Column]:
    return [F.col("_q_carry").getField(c).alias(c) for c in columns]


def judge_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source", min_group: int = MIN_GROUP,
                    steps: int = STEPS, cut: float = CUT,
                    carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all by default) of every row with its _q_
    statistics, _q_base_failed, _q_distance (null for base failures and
    groups without an estimate) and _q_kept. The measured rows are stored,
    so texts are read once; carry few columns."""
    carry = list(docs.columns) if carry is None else carry
    stored = materialize(_measured(docs, text_col, lang_col, source_col, carry), "quality-rules")
    out = _judged(stored, *_fit(stored, min_group, steps), cut)
    return out.select(*_carried(carry), *[c for c in out.columns if c != "_q_carry"])


def filter_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                     source_col: str = "source", min_group: int = MIN_GROUP,
                     steps: int = STEPS, cut: float = CUT) -> DataFrame:
    """``docs`` without the rejected documents; same columns. The statistics
    are computed twice, for the estimates and for the verdicts, so that no
    text is stored or shuffled."""
    measured = _measured(docs, text_col, lang_col, source_col, list(docs.columns))
    judged = _judged(measured, *_fit(measured, min_group, steps), cut)
    return judged.filter("_q_kept").select(*_carried(docs.columns))
