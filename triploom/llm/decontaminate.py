"""Benchmark decontamination: find benchmark n-grams in documents and remove
the documents, or the spans, that hold them.

The benchmark's windows of ``size`` words (an item with fewer words is one
window) are a hash set, keyed by the window's longest word, the least
frequent kind there is. It is broadcast, and one scan of the documents'
words looks every word up in it; where a key is found, the document's window
around the word is compared with the benchmark's by hash and then word by
word. Only verified hits leave the scan, so nothing is shuffled but hits.

The broadcast is bounded by ``max_broadcast_bytes``: the set is measured
first, and a larger one is split by key into blocks, each looked up in a
pass of its own.

Defined results: null or empty texts, on either side, have no words and no
hits; repeated benchmark rows count once; documents may repeat a doc_id or
whole rows (hits are kept per doc_id and text, and every row is returned);
empty tables give no hits; further columns are kept, and a ``_`` column
name of this module must not be in use. Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.llm.words import NOT_WORD, lower_ascii, split_words
from triploom.session import materialize

MAX_BROADCAST_BYTES = 64 << 20
MAX_BROADCAST_HITS = 1_000_000   # contaminated documents, two numbers each
ROW_OVERHEAD = 100   # bytes counted for a window's row besides its text


def words_of(text: Column) -> Column:
    return split_words(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), NOT_WORD)


def benchmark_windows(benchmark: DataFrame, size: int, text_col: str = "text",
                      id_col: str = "item_id") -> DataFrame:
    """Distinct windows: key (the longest word), at (its place), n, window
    (words), hash, items (sorted ids as strings)."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"),
                             words_of(F.col(text_col)).alias("words")) \
        .filter(F.size("words") > 0)
    cut = F.when(F.size("words") < size, F.array(F.col("words"))).otherwise(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1))),
        lambda i: F.slice("words", i, size)))
    windows = (items.select("item", F.explode(cut).alias("window"))
               .groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")))
    longest = F.array_max(F.transform("window", lambda w, i: F.struct(
        F.length(w).alias("n"), w.alias("word"), i.alias("at"))))
    return windows.withColumn("_longest", longest).select(
        F.col("_longest.word").alias("key"), F.col("_longest.at").alias("at"),
        F.size("window").alias("n"), "window", F.xxhash64("window").alias("hash"), "items")


def _blocks(windows: DataFrame, max_broadcast_bytes: int) -> list[DataFrame]:
    size = windows.agg(F.sum(F.octet_length(F.to_json(F.struct("window", "items")))
                             + ROW_OVERHEAD)).first()[0] or 0
    n = -(-size // max_broadcast_bytes)
    if n <= 1:
        return [windows]
    return [windows.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == k) for k in range(n)]


def find_hits(docs: DataFrame, benchmark: DataFrame, size: int = 10,
              text_col: str = "text", id_col: str = "doc_id",
              max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per contaminated document text: _id, _text_hash, hits (sorted
    positions of hit words), items (sorted item ids, as strings)."""
    words = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text_hash"),
                        words_of(F.col(text_col)).alias("_words"))
    tokens = words.select("_id", "_text_hash", "_words", F.posexplode("_words")
                          .alias("_pos", "_word"))
    found = []
    for block in _blocks(benchmark_windows(benchmark, size), max_broadcast_bytes):
        start = F.col("_pos") - F.col("at")
        found.append(
            tokens.join(F.broadcast(block), F.col("_word") == F.col("key"))
            .filter((start >= 0) & (start + F.col("n") <= F.size("_words")))
            .withColumn("_window", F.slice("_words", F.greatest(start, F.lit(0)) + 1,
                                           F.col("n")))
            .filter((F.xxhash64("_window") == F.col("hash"))
                    & (F.col("_window") == F.col("window")))
            .select("_id", "_text_hash", start.alias("start"), "n", "items"))
    hits = reduce(DataFrame.unionByName, found)
    covered = F.flatten(F.transform(F.collect_set(F.struct("start", "n")), lambda s: F.sequence(
        s["start"], s["start"] + s["n"] - 1)))
    return hits.groupBy("_id", "_text_hash").agg(
        F.sort_array(F.array_distinct(covered)).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")) \
        .withColumn("items", F.sort_array("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10,
                  text_col: str = "text", id_col: str = "doc_id",
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Every row of ``docs`` with _n_words, _hits (positions) and _items."""
    hits = find_hits(docs, benchmark, size, text_col, id_col, max_broadcast_bytes)
    hits = hits.select(F.col("_id").alias("_hit_id"), F.col("_text_hash").alias("_hit_hash"),
                       F.col("hits").alias("_hits"), F.col("items").alias("_items"))
    own = docs.withColumn("_n_words", F.size(words_of(F.col(text_col)))) \
        .withColumn("_text_hash", F.xxhash64(text_col))
    return own.join(hits, F.col(id_col).eqNullSafe(F.col("_hit_id"))
                    & (F.col("_text_hash") == F.col("_hit_hash")), "left") \
        .drop("_hit_id", "_hit_hash", "_text_hash")


def _without_spans(text: Column, hits: Column) -> Column:
    """``text`` without the words at ``hits`` and the gaps between them."""
    gap = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"   # in the text as it is
    parts, gaps = F.split(text, gap), F.regexp_extract_all(text, F.lit(gap), F.lit(0))
    first = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    gone = lambda i: F.array_contains(hits, i - first)
    return F.array_join(F.transform(parts, lambda p, i: F.concat(
        F.when(gone(i), "").otherwise(p),
        F.when(gone(i) & gone(i + 1), "").otherwise(
            F.coalesce(F.get(gaps, i), F.lit(""))))), "")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10,
                  remove: str = "document", text_col: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """``docs`` without contaminated documents (``remove="document"``) or
    without the hit spans of their texts (``"span"``); same columns."""
    if remove == "document":
        hits = materialize(find_hits(docs, benchmark, size, text_col, id_col).select(
            F.col("_id").alias("_hit_id"), F.col("_text_hash").alias("_hit_hash")), "hits")
        # few enough: the texts needn't be shuffled to lose some
        gone = F.broadcast(hits) if hits.count() <= MAX_BROADCAST_HITS else hits
        return docs.join(gone, F.col(id_col).eqNullSafe(F.col("_hit_id"))
                         & (F.xxhash64(text_col) == F.col("_hit_hash")), "left_anti")
    if remove != "span":
        raise ValueError("remove is 'document' or 'span'")
    found = contamination(docs, benchmark, size, text_col, id_col)
    return found.withColumn(text_col, F.when(F.col("_hits").isNull(), F.col(text_col)).otherwise(
        _without_spans(F.col(text_col), F.col("_hits")))).select(*docs.columns)
