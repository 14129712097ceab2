"""Phrases whose words occur together, counted over a prefix-free parse.

A text is lower-cased (A-Z), split into pieces at punctuation and line breaks
and those into words. Each piece is parsed into chunks that begin and end
with a trigger, two words of which the first has a hash that is 0 modulo
``PERIOD`` (or with the piece): neighbouring chunks overlap by just those two words, and equal
stretches of text give equal chunks wherever they stand. The dictionary of
distinct chunks with their frequencies stands for the texts from then on:
copies, repeated lines and passages cost one entry. n-grams are counted
inside distinct chunks, weighted by frequency: a task numbers the words that
it holds and sums up phrases as numbers before it sends them as text. A phrase
that begins in the two words that a chunk shares with the next belongs to the
next, so each occurrence counts once; phrases of more words than three would
need longer triggers (``TRIGGER`` is one word less than ``LONGEST``).

A phrase of three words is only counted if both word pairs in it are
frequent. Which they are is looked up in a table of bits of a fixed size (a
hash per frequent pair): it may let rare ones pass, which the counts remove,
but loses none, whatever the size of the data.

Null texts have no words; a null group is ``und``. Texts without words give
nothing, an empty table an empty result; repeated rows count each time.
Counts are 64-bit; products are decimals of 38 digits, exact while ``10**6 *
count ** 2`` is below ``10**38``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triploom.llm.hashing import flat_hashes, window_hashes
from triploom.session import materialize, shuffles_freed

LONGEST = 3                 # words of a phrase at most
TRIGGER = LONGEST - 1       # words that chunks overlap by
PERIOD = 12                 # about one in so many word pairs is a trigger
# A-Z in lower case, what ends a piece as a line break
PIECES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0B\x0C\x0D",
                         b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9)
BIT_TABLE = 1 << 26         # bits of the table of frequent phrases (8 MB)
HELD = 200_000              # distinct chunks that a task counts before it sends them on
SENT = 50_000               # phrases in a batch that a task sends
SALTS = 64                  # parts of a group that are ranked before the group
UNKNOWN = "und"


def parse(text: bytes) -> Iterator[tuple[bytes, bool]]:
    """The chunks of a text (words joined by blanks), each with whether its
    piece ends with it."""
    for piece in text.translate(PIECES).split(b"\n"):
        words = piece.split()    # bytes, no line breaks: at blanks and tabs only
        begin = 0
        for i in [i for i, h in enumerate(map(crc32, words[1:-TRIGGER]), 1) if not h % PERIOD]:
            yield b" ".join(words[begin:i + TRIGGER]), False
            begin = i
        if words:
            yield b" ".join(words[begin:]), True


def _sent(counts: Counter, names: list[str]) -> pa.RecordBatch:
    """The entries of a counter, keyed by (group, phrase, ...)."""
    cols = list(zip(*counts, strict=True)) if counts else [[] for _ in names[:-1]]
    kinds = [pa.string(), pa.binary(), pa.bool_()][:len(cols)]
    arrays = [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]
    arrays[1] = arrays[1].cast(pa.string())
    return pa.RecordBatch.from_arrays([*arrays, pa.array(list(counts.values()), pa.int64())], names)


def dictionary(docs: DataFrame, text: str = "text", group: str = "lang") -> DataFrame:
    """(grp, chunk, last, n): every distinct chunk of the parse of all texts
    and how often it occurs."""
    names = ["grp", "chunk", "last", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for g, t in zip(b["grp"].to_pylist(), b["text"].cast(pa.binary()), strict=True):
                raw = t.as_py() or b""    # one text at a time
                counts.update((g, c, e) for c, e in parse(raw))
                if len(counts) >= HELD:
                    yield _sent(counts, names)
                    counts.clear()
        yield _sent(counts, names)

    rows = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(UNKNOWN)).alias("grp"),
                       F.col(text).alias("text"))
    return rows.mapInArrow(work, "grp string, chunk string, last boolean, n long").groupBy(
        "grp", "chunk", "last").agg(F.sum("n").alias("n"))


class Words:
    """The words of many chunks as numbers into ``known``, the distinct ones;
    for each its group's number, its chunk's count and how many words are left
    in the chunk, itself included."""

    def __init__(self, batches: list[pa.RecordBatch], lists: list[pa.ListArray]):
        words = pa.concat_arrays([x.flatten() for x in lists]).dictionary_encode()
        group = pa.concat_arrays([b["grp"] for b in batches]).dictionary_encode()
        self.known, self.groups = words.dictionary, group.dictionary
        self.word = words.indices.to_numpy()
        sizes = np.concatenate([pc.list_value_length(x).to_numpy() for x in lists])
        self.sizes = sizes.astype(np.int64)
        ends = np.cumsum(self.sizes)
        self.group = self.each(group.indices.to_numpy())
        self.times = self.each(np.concatenate([b["n"].to_numpy() for b in batches]))
        self.left = self.each(ends) - np.arange(len(self.word))

    def each(self, of_chunks: np.ndarray) -> np.ndarray:
        """A value of every chunk, for each of its words."""
        return np.repeat(of_chunks, self.sizes)

    def counted(self, begins: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
        """(grp, phrase, n) of the phrases of ``size`` words that begin at
        ``begins``, summed."""
        keys = ["grp", *map(str, range(size))]
        columns = [self.group[begins], *(self.word[begins + k] for k in range(size)),
                   self.times[begins]]
        got = pa.table(columns, [*keys, "n"]).group_by(keys, use_threads=False).aggregate(
            [("n", "sum")])
        for part in got.to_batches(max_chunksize=SENT):
            words = [self.known.take(part[k]) for k in keys[1:]]
            phrase = pc.binary_join_element_wise(*words, " ") if size > 1 else words[0]
            yield pa.RecordBatch.from_arrays(
                [self.groups.take(part["grp"]), phrase, part["n_sum"]], ["grp", "phrase", "n"])


def held_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[pa.RecordBatch]]]:
    """The words of all batches, as many at a time as ``HELD`` chunks have or
    so, with the batches they are of."""
    held: list[pa.RecordBatch] = []
    lists: list[pa.ListArray] = []
    size = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            lists.append(pc.split_pattern(b["chunk"], " "))
            size += len(lists[-1].flatten())
        if size >= HELD * PERIOD:
            yield Words(held, lists), held
            held, lists, size = [], [], 0
    if held:
        yield Words(held, lists), held


def _places(words: np.ndarray) -> np.ndarray:
    """The place in the bit table of every word (a hash) with its next one;
    that of the last word means nothing."""
    places = np.zeros(len(words), np.int64)
    places[:-1] = window_hashes(words, 2) % np.uint64(BIT_TABLE)
    return places


def bit_table(pairs: DataFrame) -> bytes:
    """A bit per frequent word pair, at its hash: at most ``BIT_TABLE`` / 64
    numbers reach the driver, whatever there is."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, counts = flat_hashes(b["phrase"].cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(_places(words)[np.cumsum(counts) - counts])], ["at"])

    words = (pairs.select("phrase").mapInArrow(work, "at long")
             .groupBy(F.expr("cast(at div 64 as int)").alias("w"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(at % 64 as int)))").alias("bits")).toArrow())
    table = np.zeros(BIT_TABLE // 64, np.int64)
    table[words["w"].to_numpy()] = words["bits"].to_numpy()
    return table.tobytes()


def short_counts(chunks: DataFrame) -> DataFrame:
    """(grp, phrase, n): occurrences of every word and word pair. What begins
    in the two last words of a chunk is the next chunk's, unless its piece
    ends there."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, held in held_words(batches):
            last = np.concatenate([b["last"].to_numpy(zero_copy_only=False) for b in held])
            own = words.left > words.each(np.where(last, 0, TRIGGER))
            yield from words.counted(np.flatnonzero(own), 1)
            yield from words.counted(np.flatnonzero(own & (words.left > 1)), 2)

    return chunks.mapInArrow(work, "grp string, phrase string, n long").groupBy(
        "grp", "phrase").agg(F.sum("n").alias("n"))


def triple_counts(chunks: DataFrame, frequent_pairs: bytes) -> DataFrame:
    """(grp, phrase, n): occurrences of every phrase of three words both of
    whose pairs are in the table of frequent ones."""
    held_table = chunks.sparkSession.sparkContext.broadcast(frequent_pairs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(held_table.value, np.uint8)
        for words, _ in held_words(batches):
            hashes, _ = flat_hashes(words.known.cast(pa.binary()).to_pylist())
            places = _places(hashes[words.word])
            known = (table[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0
            # two pairs of one chunk, so not from its last two words on
            both = known & (words.left >= LONGEST)
            both[:-1] &= known[1:]
            yield from words.counted(np.flatnonzero(both), LONGEST)

    return chunks.select("grp", "chunk", "n").mapInArrow(
        work, "grp string, phrase string, n long").groupBy("grp", "phrase").agg(
        F.sum("n").alias("n"))


def _cut(phrases: DataFrame, parts: DataFrame, k: int, size: int) -> DataFrame:
    """Phrases of ``size`` words with the counts of their parts when cut after
    ``k`` words (a part of a frequent phrase is frequent)."""
    first = F.substring_index("phrase", " ", k)
    rest = F.substring_index("phrase", " ", k - size)
    left = parts.select("grp", F.col("phrase").alias("_first"), F.col("n").alias("l"))
    right = parts.select("grp", F.col("phrase").alias("_rest"), F.col("n").alias("r"))
    return (phrases.withColumn("_first", first).withColumn("_rest", rest)
            .join(left, ["grp", "_first"]).join(right, ["grp", "_rest"])
            .select("grp", "phrase", "a", F.lit(k).alias("k"), "l", "r", F.expr(
                "cast(1000000 as decimal(38,0)) * a * a div (cast(l as decimal(38,0)) * r)")
                .alias("score")))


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", least: int = 10,
                 best: int = 2000, covered: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each group's ``best`` phrases
    of 2 to ``LONGEST`` words with at least ``least`` occurrences, by score
    (of the lowest-scoring cut), occurrences and text. A phrase of which a
    longer one covers at least ``covered`` percent is left out."""
    is_pair = F.instr("phrase", " ") > 0
    # the shuffles of two tables need not be on disk together
    with shuffles_freed(docs.sparkSession):
        chunks = materialize(dictionary(docs, text, group), "chunks")
        parts = materialize(short_counts(chunks).filter(F.col("n") >= least), "phrases")
        table = bit_table(parts.filter(is_pair))
        triples = materialize(triple_counts(chunks, table).filter(F.col("n") >= least), "triples")
    own_words = F.size(F.split("chunk", " ")) - F.when(F.col("last"), 0).otherwise(TRIGGER)
    total = chunks.groupBy("grp").agg(F.sum(F.col("n") * own_words).alias("n"))
    pairs = parts.filter(is_pair)
    frequent = [parts.filter(~is_pair), pairs, triples]
    cuts = None
    for size, rows in enumerate(frequent[1:], 2):
        rows = rows.select("grp", "phrase", F.col("n").alias("a"))
        for k in range(1, size):
            cut = _cut(rows, parts, k, size)
            cuts = cut if cuts is None else cuts.unionByName(cut)
    scored = cuts.groupBy("grp", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a"))
                                               .alias("_c")).select("grp", "phrase", "_c.*")

    # how often the most frequent longer phrase around it occurs
    around = None
    for size, rows in enumerate(frequent[2:], 3):
        for sub in range(2, size):
            for at in range(size - sub + 1):
                inner = F.substring_index(F.substring_index("phrase", " ", at + sub), " ", -sub)
                inside = rows.select("grp", inner.alias("phrase"), "n")
                around = inside if around is None else around.unionByName(inside)
    if around is not None:
        most = around.groupBy("grp", "phrase").agg(F.max("n").alias("_most"))
        scored = scored.join(most, ["grp", "phrase"], "left").filter(
            F.coalesce(100 * F.col("_most") < covered * F.col("a"), F.lit(True)))

    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    few = (scored.withColumn("_salt", salt).withColumn("_place", F.row_number().over(
        Window.partitionBy("grp", "_salt").orderBy(*order))).filter(F.col("_place") <= best))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(
        *order))).filter(F.col("rank") <= best)
    # one row a group, read once: a group is a language
    return ranked.join(total, "grp").select(
        F.col("grp").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l",
        "r", "n", F.col("score").cast("long").alias("score"))
