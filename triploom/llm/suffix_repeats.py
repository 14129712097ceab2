"""Suffix-array dedup with sparse suffix arrays: passages that occur more
than once in a corpus, within a document or across documents.

Of each text's suffixes, those at content-selected positions are retained:
the minimisers, the least hash of ``anchor`` words in every window of
``least`` words. Two equal passages of ``least`` words select the same
positions, whatever stands around them. The retained suffixes are sorted by
content (the hashes of their next words) across the cluster, by a range
partitioning that splits even one suffix content's rows over tasks, and
neighbours are compared: a suffix that shares its anchor with a neighbour is
a candidate (as are the two at a task's ends, whose neighbours are
elsewhere). A candidate's match is then extended left and right, over the
windows of ``least`` words that selected it: the whole extended stretch is
compared by hash, and where stretches differ, their windows are. A word is
repeated if it lies in a window of ``least`` words that occurs twice.

Copies cost little: equal stretches are one row with a count and the first
occurrence, pre-aggregated before the shuffle.

Defined results: null and empty texts and texts shorter than ``least``
words have no repeats; a doc_id with several texts is a document for each;
documents with a null id come first; equal rows are copies of each other, of
which one holds the first occurrences; an empty table gives no rows; further
columns are not read. Words are runs without ASCII white space, as written.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triploom.llm.hashing import mix, word_hashes
from triploom.session import materialize, scratch_scope

LEAST = 50      # words of the shortest passage
ANCHOR = 17     # words of an anchor; LEAST - ANCHOR + 1 anchors a window
_U = np.uint64
_LEFT = _U(0xA0761D6478BD642F)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash per run of ``size`` words, by doubling."""
    if len(words) < size:
        return np.empty(0, _U)
    total, done, step, power = None, 0, 1, words
    while True:
        if size & step:
            if total is None:
                total = power
            else:
                tail = power[done:]
                n = min(len(total), len(tail))
                total = mix(total[:n] * _LEFT + tail[:n])
            done += step
        if done == size:
            return total[:len(words) - size + 1]
        power = mix(power[:-step] * _LEFT + power[step:]) if len(power) > step else power[:0]
        step *= 2


def minimisers(words: np.ndarray, least: int, anchor: int):
    """(positions, first window, last window) of the anchors that windows of
    ``least`` words select, and the anchor hashes of all positions."""
    anchors = run_hashes(words, anchor)
    per = least - anchor + 1
    if len(anchors) < per:
        return (np.empty(0, np.int64),) * 3 + (anchors,)
    view = np.lib.stride_tricks.sliding_window_view(anchors, per)
    chosen = np.arange(len(view)) + view.argmin(axis=1)
    at = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    return chosen[at], at, np.concatenate([at[1:], [len(chosen)]]) - 1, anchors


def _suffixes(docs: DataFrame, least: int, anchor: int) -> DataFrame:
    """Retained suffixes: uid, pos, lo, hi (windows that select it), and the
    hashes of its first and second ``anchor`` words."""
    def retain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            uid, rows = b["uid"].to_numpy(), []
            counts = []
            for words in word_hashes(list(b["text"]), lower=False):
                pos, lo, hi, anchors = minimisers(words, least, anchor)
                after = np.zeros(len(pos), _U)
                inside = pos + anchor < len(anchors)
                after[inside] = anchors[pos[inside] + anchor]
                rows.append((pos, lo, hi, anchors[pos].view(np.int64), after.view(np.int64)))
                counts.append(len(pos))
            cols = [np.concatenate(c) for c in zip(*rows)] if rows else [np.empty(0, int)] * 5
            yield pd.DataFrame(dict(zip(("pos", "lo", "hi", "head", "next"), cols))
                               | {"uid": np.repeat(uid, counts)})[
                ["uid", "pos", "lo", "hi", "head", "next"]]

    return docs.mapInPandas(retain, "uid long, pos long, lo long, hi long, head long, next long")


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of a task's sorted suffixes, those that share their head with a
    neighbour; the first and the last, too."""
    held, held_keep, first = None, False, True
    for b in batches:
        if not len(b):
            continue
        b = b if held is None else pd.concat([held, b], ignore_index=True)
        head = b["head"].to_numpy()
        same = head[1:] == head[:-1]
        keep = np.concatenate([[first], same]) | np.concatenate([same, [False]])
        if held is not None:
            keep[0] |= held_keep
        # the last row waits for its next neighbour
        held, held_keep, first = b.iloc[-1:].reset_index(drop=True), keep[-1], False
        yield b[keep & (np.arange(len(b)) < len(b) - 1)][["uid", "lo", "hi"]]
    if held is not None:
        yield held[["uid", "lo", "hi"]]


def _stretches(docs: DataFrame, least: int) -> DataFrame:
    """Per candidate of a text: uid, doc_id, lo, two hashes of the stretch of
    words that its windows cover, and the hashes of the windows."""
    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, columns = [], ["uid", "doc_id", "lo", "r1", "r2", "windows"]
            for words, uid, doc, lows, highs in zip(word_hashes(list(b["text"]), lower=False),
                                                    b["uid"], b["doc_id"], b["lo"], b["hi"]):
                windows = run_hashes(words, least)
                # the windows of all stretches, one after another
                ends = np.unique(np.stack([lows, highs], axis=1), axis=0)
                n = ends[:, 1] - ends[:, 0] + 1
                first = np.cumsum(n) - n
                place = np.arange(int(n.sum())) - np.repeat(first, n)
                own = windows[np.repeat(ends[:, 0], n) + place]
                places = mix((place + 1).astype(_U))
                one = np.bitwise_xor.reduceat(mix(own ^ places), first).view(np.int64)
                two = np.add.reduceat(mix(own + places * _LEFT), first).view(np.int64)
                out.append(pd.DataFrame({
                    "uid": uid, "doc_id": doc, "lo": ends[:, 0], "r1": one, "r2": two,
                    "windows": np.split(own.view(np.int64), first[1:])}))
            yield pd.concat(out) if out else pd.DataFrame(columns=columns)

    # ids travel as text: null ones would turn the others into doubles
    return docs.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(
        extend, "uid long, doc_id string, lo long, r1 long, r2 long, "
                "windows array<long>").withColumn("doc_id", F.col("doc_id").cast("long"))


def _merged(rows: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Spans from the starts of repeated windows: all, and those that are no
    first occurrence."""
    def spans(starts: np.ndarray) -> list[list[int]]:
        starts = np.unique(starts)
        if not len(starts):
            return []
        cut = np.flatnonzero(np.diff(starts) > least)
        return [[int(a), int(b) + least] for a, b in zip(
            starts[np.concatenate([[0], cut + 1])],
            starts[np.concatenate([cut, [len(starts) - 1]])])]

    for b in rows:
        every = [spans(np.asarray(s, np.int64)) for s in b["starts"]]
        later = [spans(np.asarray(s, np.int64)) for s in b["later"]]
        yield pd.DataFrame({"uid": b["uid"], "doc_id": b["doc_id"], "spans": every,
                            "removable": later, "copies": b["copies"]})


def _text_spans(docs: DataFrame, text_col: str, id_col: str, least: int,
                anchor: int) -> DataFrame:
    """Like :func:`repeated_spans`, but equal rows are one with the number of
    copies; removable is that of the first copy."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text")) \
        .withColumn("uid", F.xxhash64("doc_id", "text"))
    with scratch_scope(docs.sparkSession) as scratch:
        suffixes = materialize(_suffixes(docs.select("uid", "text"), least, anchor), "suffixes")
        keys = ["head", "next", "uid", "pos"]
        candidates = (suffixes.repartitionByRange(*keys).sortWithinPartitions(*keys)
                      .mapInPandas(_neighbours, "uid long, lo long, hi long"))
        per_text = materialize(candidates.groupBy("uid").agg(
            F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi")), "candidates")
        scratch.pop()   # only the candidates stay
    found = materialize(_stretches(docs.join(per_text, "uid"), least), "stretches")

    stretch = materialize(found.groupBy("r1", "r2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "uid", "lo")).alias("first"),
        F.first("windows").alias("windows")), "distinct-stretches")
    # windows of different stretches are compared one by one
    each = stretch.select("r1", "r2", "n", "first", F.posexplode("windows").alias("k", "w"))
    place = F.struct(F.col("first.doc_id").alias("doc_id"), F.col("first.uid").alias("uid"),
                     (F.col("first.lo") + F.col("k")).alias("start"))
    known = each.groupBy("w").agg(F.sum("n").alias("n"), F.min(place).alias("first")) \
        .filter("n > 1")
    repeated = (each.select("r1", "r2", "k", "w").join(known, "w")
                .groupBy("r1", "r2").agg(F.collect_list(F.struct("k", "first")).alias("again")))
    hits = found.select("uid", "doc_id", "lo", "r1", "r2").join(repeated, ["r1", "r2"])
    start = lambda x: F.col("lo") + x["k"]
    hits = hits.select(
        "uid", "doc_id", "lo", F.transform("again", start).alias("starts"),
        F.transform(F.filter("again", lambda x: (x["first"]["uid"] != F.col("uid"))
                             | (x["first"]["start"] != start(x))), start).alias("later"))
    by_text = hits.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"), F.flatten(F.collect_list("starts")).alias("starts"),
        F.flatten(F.collect_list("later")).alias("later"), F.collect_list("lo").alias("lo"))
    # each of the equal rows brings every place of the text
    copies = (F.size("lo") / F.size(F.array_distinct("lo"))).cast("long")
    by_text = by_text.select("uid", F.col("doc_id").cast("string").alias("doc_id"), "starts",
                             "later", copies.alias("copies"))
    return by_text.mapInPandas(
        lambda rows: _merged(rows, least),
        "uid long, doc_id string, spans array<array<long>>, removable array<array<long>>, "
        "copies long").withColumn("doc_id", F.col("doc_id").cast("long"))


def repeated_spans(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   least: int = LEAST, anchor: int = ANCHOR) -> DataFrame:
    """One row per document with repeated passages: uid, doc_id, spans and
    removable (arrays of [start, end) in words); removable leaves out the
    first occurrence of each passage (by doc_id, then place)."""
    found = _text_spans(docs, text_col, id_col, least, anchor)
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select("uid", "doc_id", "spans", F.when(
        F.col("copy") == 1, F.col("removable")).otherwise(F.col("spans")).alias("removable"))


def remove_repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                   least: int = LEAST, anchor: int = ANCHOR) -> DataFrame:
    """``docs`` without the later occurrences of repeated passages: their
    words are cut from the text, with the white space after them."""
    found = materialize(_text_spans(docs, text_col, id_col, least, anchor), "text-spans").select(
        F.col("uid").alias("_s_uid"), F.col("removable").alias("_s_cut"),
        F.col("spans").alias("_s_spans"), F.col("copies").alias("_s_copies"))
    keyed = docs.withColumn("_s_uid", F.xxhash64(
        F.col(id_col).cast("long"), F.col(text_col).cast("string")))
    many = found.filter("_s_copies > 1")
    joined = keyed.join(found.filter("_s_copies = 1").select("_s_uid", "_s_cut"), "_s_uid", "left")
    if many.limit(1).count():
        # of equal rows, all but one lose the first occurrences, too
        joined = joined.join(many.select("_s_uid"), "_s_uid", "left_anti")
        rows = materialize(keyed.join(many, "_s_uid").withColumn(
            "_s_row", F.monotonically_increasing_id()), "equal-rows")
        first = rows.groupBy("_s_uid").agg(F.min("_s_row").alias("_s_first"))
        joined = joined.unionByName(rows.join(first, "_s_uid").withColumn("_s_cut", F.when(
            F.col("_s_row") == F.col("_s_first"), F.col("_s_cut")).otherwise(F.col("_s_spans")))
            .select(*joined.columns))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, gone in zip(texts, spans):
            if text is not None and gone is not None and len(gone):
                edges = [m.start() for m in _WORD.finditer(text)] + [len(text)]
                kept, at = [], 0
                for a, b in gone:
                    kept.append(text[at:edges[a]])
                    at = edges[b]
                text = "".join(kept) + text[at:]
            out.append(text)
        return pd.Series(out, dtype=object)

    return joined.withColumn(text_col, cut(F.col(text_col), F.col("_s_cut"))).select(
        *docs.columns)
