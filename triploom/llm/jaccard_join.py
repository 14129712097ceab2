"""N-gram Jaccard join: all documents whose shingle sets are similar, by
token-combination prefixes.

A document's tokens are the hashes of its distinct word shingles. Tokens
that occur in very many documents form the frequent class; they are found
by merging the local counts of all input batches. Tokens are ordered with
the rare class first, and a document's prefix is its first
``e + 1 + groups`` tokens, where ``e`` is the number of tokens that a
similar document may lack. Similar documents share more than ``groups``
prefix tokens, so they share a rare one, or two frequent ones of the same
one of ``groups`` token groups. Rare prefix tokens are therefore indexed
singly and frequent ones as two-token combinations within a group. (The
number of groups depends on the size class; a document is indexed for each
class that a similar larger document can be in.)

Verification is exact, on whole sets, and keeps links between different
texts whole without listing the pairs of a group: documents with equal sets
are one node; each index bucket first compares its members with its
smallest; only pairs that are then still in different components are
compared further: in rare buckets, pairs that share enough prefix tokens;
among documents of frequent tokens, in blocks of a cluster, where a block
pair returns at most one link per member.

Defined results: null and empty texts have no tokens and link with nothing;
a text with fewer words than a shingle is one token; rows are told apart by
id and text, so an id with several texts is a document for each, null ids
are documents like others (a component's smallest id is null if it has no
other) and equal rows are copies, of which :func:`keep_one` keeps one; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triploom.llm.components import components
from triploom.llm.hashing import mix, window_hashes, word_hashes
from triploom.session import materialize, scratch_scope

SHINGLE_WORDS = 4
PERCENT = 85
LOCAL_LEAST = 4        # a batch reports tokens with that many documents at least
SHARE = 1 / 2000       # of all documents: from there on a token is frequent,
FREQUENT_LEAST = 64    # but only with that many documents
MAX_FREQUENT = 4_000_000   # tokens in the broadcast (8 bytes each), the most frequent
MAX_BROADCAST_IDS = 2_000_000
SLICE_CHARS = 2 << 20  # texts that are turned into sets at once
BLOCK = 512            # documents a block of a cluster


def token_sets(texts, words: int) -> Iterator[np.ndarray]:
    """Per text, its sorted distinct shingle hashes."""
    for h in word_hashes(list(texts), lower=True):
        if len(h) >= words:
            yield np.unique(window_hashes(h, words))
        elif len(h):
            # the whole sequence; the words' number keeps it apart
            yield mix(window_hashes(h, len(h)) + np.uint64(len(h)))
        else:
            yield h


def _slices(b: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in runs of rows with about ``SLICE_CHARS`` of text, so that
    what a task holds and sends at once doesn't follow the texts' length."""
    at = b["text"].str.len().fillna(0).cumsum() // SLICE_CHARS
    for _, part in b.groupby(at, sort=False):
        yield part


def allowed_misses(n, percent: int):
    """How many of n tokens a similar document may lack."""
    return n - -(-n * percent // 100)


def token_groups(size_class: int, percent: int) -> int:
    """Groups of the frequent tokens for sets of 2**size_class tokens on."""
    return max(1, int(allowed_misses(1 << size_class, percent)) // 4)


def _size_classes(n: int, percent: int) -> list[int]:
    """Classes of the sizes that a similar, not smaller set can have."""
    return list(range(n.bit_length() - 1, (n * 100 // percent).bit_length()))


def _frequent_tokens(docs: DataFrame, words: int) -> tuple[DataFrame, int]:
    """Tokens frequent somewhere, with their counted documents (at least
    what the batches that report them hold), and the number of documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            tokens = np.concatenate([*token_sets(b["text"], words), np.empty(0, np.uint64)])
            tokens.sort()
            at = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) \
                if len(tokens) else np.empty(0, int)
            n = np.diff(np.concatenate([at, [len(tokens)]]))
            keep = n >= max(LOCAL_LEAST, len(b) * SHARE)
            yield pd.DataFrame({"token": np.concatenate([tokens[at[keep]].view(np.int64), [0]]),
                                "n": np.concatenate([n[keep], [0]]),
                                "docs": np.concatenate([np.zeros(keep.sum(), int), [len(b)]])})

    counted = docs.select("text").mapInPandas(count, "token long, n long, docs long")
    counted = materialize(counted.groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")), "frequent")
    n_docs = counted.agg(F.sum("docs")).first()[0] or 0
    return counted.filter(F.col("n") >= max(FREQUENT_LEAST, int(n_docs * SHARE))), n_docs


def _combinations(tokens: np.ndarray, size_class: int, percent: int) -> np.ndarray:
    """Signatures of the pairs of tokens within each group of the class."""
    group = (mix(tokens ^ np.uint64(0x5851F42D4C957F2D))
             % np.uint64(token_groups(size_class, percent))).astype(np.int64)
    out = []
    for g in np.unique(group):
        own = np.sort(tokens[group == g])
        i, j = np.triu_indices(len(own), 1)
        out.append(mix(mix(own[i] + np.uint64(size_class)) ^ own[j]))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _signatures(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """doc_id, n, set_hash (two longs), singles and pairs (signatures), and
    need: how many singles a similar document shares at least."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = shared.value
        for b in (part for batch in batches for part in _slices(batch)):
            out = []
            for tokens in token_sets(b["text"], words):
                n = len(tokens)
                h1 = int(mix(np.array([np.bitwise_xor.reduce(mix(tokens)) if n else 0],
                                      np.uint64) + np.uint64(n)).view(np.int64)[0])
                h2 = int(np.add.reduce(mix(tokens ^ np.uint64(n))).astype(np.uint64)
                         .view(np.int64)) if n else 0
                singles = pairs = np.empty(0, np.uint64)
                need = 1
                if n > 1:
                    e = int(allowed_misses(n, percent))
                    classes = _size_classes(n, percent)
                    extra = max(token_groups(c, percent) for c in classes)
                    if len(often):
                        at = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
                        hot = often[at] == tokens
                        first = np.concatenate([tokens[~hot], tokens[hot]])
                        n_rare = n - int(hot.sum())
                    else:
                        first, n_rare = tokens, n
                    prefix = first[:e + 1 + extra]
                    singles, often_ones = prefix[:n_rare], prefix[n_rare:]
                    need = max(1, len(prefix) - e - len(often_ones))
                    if len(often_ones) > 1:
                        pairs = np.concatenate([_combinations(often_ones, c, percent)
                                                for c in classes])
                out.append((n, h1, h2, singles.view(np.int64), pairs.view(np.int64), need))
            n, h1, h2, singles, pairs, need = map(list, zip(*out)) if out else [[]] * 6
            yield pd.DataFrame({"doc_id": b["doc_id"], "n": n, "h1": h1, "h2": h2,
                                "singles": singles, "pairs": pairs, "need": need})

    return docs.select("doc_id", "text").mapInPandas(
        sign, "doc_id long, n long, h1 long, h2 long, singles array<long>, "
              "pairs array<long>, need long")


def _chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents with the given ids. Their texts are not shuffled while
    the ids are few enough to broadcast."""
    ids = materialize(ids.toDF("doc_id").distinct(), "ids")
    small = ids.count() <= MAX_BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("a").union(pairs.select("b"))


def _whole_sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(doc_id, tokens) of the documents with the given ids."""
    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (part for batch in batches for part in _slices(batch)):
            sets = [t.view(np.int64) for t in token_sets(b["text"], words)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": sets})

    return materialize(_chosen(docs, ids).mapInPandas(
        whole, "doc_id long, tokens array<long>"), "sets")


def _possible(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that can be similar by the 16-bit prints of their tokens, a
    quarter of the sets' size. Prints are shared at least as often as tokens,
    but for tokens of one set that share a print, which are added."""
    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (part for batch in batches for part in _slices(batch)):
            sets = list(token_sets(b["text"], words))
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "n": [len(t) for t in sets],
                "prints": [np.unique((t >> np.uint64(24)).astype(np.uint16)).view(np.int16)
                           for t in sets]})

    marks = materialize(_chosen(docs, _ends(pairs)).mapInPandas(
        prints, "doc_id long, n long, prints array<short>"), "prints")
    left = marks.select(F.col("doc_id").alias("a"), F.col("n").alias("na"),
                        F.col("prints").alias("pa"))
    right = marks.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"),
                         F.col("prints").alias("pb"))
    most = F.size(F.array_intersect("pa", "pb")) + F.least(
        F.col("na") - F.size("pa"), F.col("nb") - F.size("pb"))
    most = F.least(most, F.col("na"), F.col("nb"))
    return materialize(
        pairs.join(left, "a").join(right, "b").withColumn("most", most)
        .filter(F.col("most") * 100 >= (F.col("na") + F.col("nb") - F.col("most")) * percent)
        .select("a", "b"), "possible")


def _compatible(a: str, b: str, percent: int):
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""
    pairs = _possible(pairs, docs, words, percent)
    sets = _whole_sets(docs, _ends(pairs), words)
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .filter(F.col("both") * 100 >= (F.size("ta") + F.size("tb") - F.col("both")) * percent)
            .select("a", "b"))


def _block_links(percent: int):
    """Links of one block pair: exact set sizes by counting shared tokens in
    a matrix; at most one link per pair of parts that it connects."""
    def links(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = int(rows["i"].iloc[0]), int(rows["j"].iloc[0])
        left = rows[rows["block"] == i].reset_index(drop=True)
        right = rows[rows["block"] == j].reset_index(drop=True)
        tokens = np.concatenate([np.asarray(t, np.int64) for t in rows["tokens"]])
        vocab = np.unique(tokens)

        def placed(side):
            n = side["tokens"].map(len).to_numpy()
            at = np.searchsorted(vocab, np.concatenate(
                [np.asarray(t, np.int64) for t in side["tokens"]]))
            return np.repeat(np.arange(len(side)), n), at, n

        (lr, lc, ln), (rr, rc, rn) = placed(left), placed(right)
        shared = np.zeros((len(left), len(right)), np.float32)
        for start in range(0, len(vocab), 4096):
            a = np.zeros((len(left), 4096), np.float32)
            b = np.zeros((len(right), 4096), np.float32)
            for m, r, c in ((a, lr, lc), (b, rr, rc)):
                own = (c >= start) & (c < start + 4096)
                m[r[own], c[own] - start] = 1
            shared += a @ b.T
        similar = shared * 100 >= (ln[:, None] + rn[None, :] - shared) * percent
        lk, rk = left["component"].to_numpy(), right["component"].to_numpy()
        similar &= lk[:, None] != rk[None, :]
        parent: dict[int, int] = {}

        def root(x):
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        for x, y in zip(*np.nonzero(similar)):
            p, q = root(lk[x]), root(rk[y])
            if p != q:
                parent[p] = q
                out.append((int(left["doc_id"][x]), int(right["doc_id"][y])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def _cluster_links(pairs_index: DataFrame, stars: DataFrame, docs: DataFrame,
                   component, words: int, percent: int) -> DataFrame:
    """Links among the documents of frequent tokens: clusters of documents
    that share a combination, compared block by block."""
    cluster = components(stars.select("a", "b"))
    members = pairs_index.select("doc_id").distinct().join(
        cluster.withColumnRenamed("node", "doc_id"), "doc_id") \
        .withColumnRenamed("component", "cluster")
    members = component(members)
    mixed = (members.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"), F.min("component").alias("lo"),
        F.max("component").alias("hi")).filter("lo <> hi")
        .select("cluster", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))
    placed = members.join(mixed, "cluster").withColumn(
        "block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("cluster", "doc_id", "component", "block",
                F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    sets = _whole_sets(docs, placed.select("doc_id"), words)
    rows = placed.join(sets, "doc_id")
    return rows.groupBy("cluster", "i", "j").applyInPandas(_block_links(percent),
                                                           "a long, b long")


def _row_key(text_col: str, id_col: str) -> Column:
    """A row's key, never null: the hash of its id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def _row_components(docs: DataFrame, text_col: str, id_col: str, words: int,
                    percent: int) -> DataFrame:
    """One row per document: uid (row key), n, part (the component's smallest
    uid)."""
    rows = docs.select(_row_key(text_col, id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    with scratch_scope(docs.sparkSession) as scratch:
        found = materialize(_components(rows, words, percent), "jaccard")
        scratch.pop()   # only the result stays
    return found.select(F.col("doc_id").alias("uid"), "n", F.col("component").alias("part"))


def _with_ids(found: DataFrame, docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    ids = docs.select(_row_key(text_col, id_col).alias("uid"),
                      F.col(id_col).cast("long").alias("doc_id")).distinct()
    return found.join(ids, "uid")


def jaccard_components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                       words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n (set size), component (the smallest
    doc_id reachable by links, its own included)."""
    found = materialize(_with_ids(_row_components(docs, text_col, id_col, words, percent),
                                  docs, text_col, id_col), "jaccard-ids")
    # most documents are alone
    least = found.groupBy("part").agg(F.min("doc_id").alias("component"),
                                      F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return found.join(least, "part", "left").select("doc_id", "n", F.when(
        F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component"))


def _components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    counted, _ = _frequent_tokens(docs, words)
    top = counted.orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token")
    frequent = np.sort(np.array([r[0] for r in top.toLocalIterator()], np.int64).view(np.uint64))
    signed = materialize(_signatures(docs, frequent, words, percent), "signatures")

    # documents with equal sets are one node: the smallest doc_id
    nodes = materialize(signed.filter("n > 0").groupBy("h1", "h2", "n").agg(
        F.min("doc_id").alias("node"), F.first("need").alias("need")), "nodes")
    copies = materialize(signed.select("doc_id", "h1", "h2", "n").join(
        nodes.select("h1", "h2", "n", "node"), ["h1", "h2", "n"])
        .filter("doc_id <> node").select("doc_id", "h1", "h2").distinct(), "copies")
    few = copies.count() <= MAX_BROADCAST_IDS
    one = signed.filter("n > 1").join(F.broadcast(copies) if few else copies,
                                      ["doc_id", "h1", "h2"], "left_anti")

    in_bucket = Window.partitionBy("sig")
    singles = materialize(
        one.select("doc_id", F.explode("singles").alias("sig"))
        .withColumn("first", F.min("doc_id").over(in_bucket))
        .withColumn("last", F.max("doc_id").over(in_bucket))
        .filter("first <> last").drop("last"), "singles")
    combos = one.filter(F.size("pairs") > 0).select("doc_id", F.explode("pairs").alias("sig"))
    heads = combos.groupBy("sig").agg(F.min("doc_id").alias("first"),
                                      F.max("doc_id").alias("last")).filter("first <> last")
    combos = materialize(combos.join(heads.drop("last"), "sig"), "combinations")

    size = nodes.select(F.col("node").alias("doc_id"), "n", "need")

    def compatible(pairs: DataFrame) -> DataFrame:
        sized = pairs.join(size.select(F.col("doc_id").alias("a"), F.col("n").alias("na")), "a") \
            .join(size.select(F.col("doc_id").alias("b"), F.col("n").alias("nb")), "b")
        return sized.filter(_compatible("na", "nb", percent)).select("a", "b")

    stars = singles.union(combos.select(*singles.columns)).filter("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = materialize(compatible(stars), "star-pairs")
    links = materialize(_verified(stars, docs, words, percent), "stars")
    found = materialize(components(links), "components")

    def component(rows: DataFrame) -> DataFrame:
        return rows.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left") \
            .withColumn("component", F.coalesce("component", "doc_id"))

    own = component(singles.select("doc_id", "sig"))
    mixed = own.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component")
                                   .alias("hi")).filter("lo <> hi").select("sig")
    own = own.join(mixed, "sig", "left_semi").join(size, "doc_id")
    left = own.select("sig", *[F.col(c).alias(f"{c}_a") for c in ("doc_id", "component", "n",
                                                                 "need")])
    right = own.select("sig", *[F.col(c).alias(f"{c}_b") for c in ("doc_id", "component", "n",
                                                                  "need")])
    rest = (left.join(right, "sig")
            .filter((F.col("doc_id_a") < F.col("doc_id_b"))
                    & (F.col("component_a") != F.col("component_b"))
                    & _compatible("n_a", "n_b", percent))
            .groupBy(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))
            .agg(F.count(F.lit(1)).alias("shared"),
                 F.least(F.first("need_a"), F.first("need_b")).alias("need"))
            .filter("shared >= need").select("a", "b"))
    rest = materialize(rest, "rest-pairs")
    more = materialize(_verified(rest, docs, words, percent), "rest")
    of_pairs = combos.filter("doc_id <> first").select(
        F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct()
    deep = materialize(_cluster_links(combos, of_pairs, docs, component, words,
                                      percent), "clusters")

    final = components(links.union(more).union(deep))
    by_set = nodes.join(final, "node", "left").select(
        "h1", "h2", F.coalesce("component", "node").alias("component"))
    return signed.select("doc_id", "n", "h1", "h2").join(by_set, ["h1", "h2"], "left").select(
        "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
             words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest id
    (null ids last; of equal rows, the one with the least hash); same columns."""
    found = _row_components(docs, text_col, id_col, words, percent).filter("n > 0")
    same = found.groupBy("uid", "part").agg(F.count(F.lit(1)).alias("rows"))
    same = materialize(_with_ids(same, docs, text_col, id_col), "rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "uid")
    first = same.groupBy("part").agg(F.min(order).alias("first"), F.sum("rows").alias("all")) \
        .filter("all > 1").select("part", F.col("first.uid").alias("first"))
    gone = materialize(same.join(first, "part").filter("rows > 1 or uid <> first").select(
        F.col("uid").alias("_j_uid"), (F.col("uid") == F.col("first")).alias("_j_first")),
        "copies")

    def small(uids: DataFrame, n: int) -> DataFrame:
        # few enough: the texts needn't be shuffled to lose some
        return F.broadcast(uids) if n <= MAX_BROADCAST_IDS else uids

    key = _row_key(text_col, id_col) == F.col("_j_uid")
    kept = docs.join(small(gone.select("_j_uid"), gone.count()), key, "left_anti")
    again = gone.filter("_j_first").select("_j_uid")
    n_again = again.count()
    if not n_again:
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (docs.join(small(again, n_again), key).groupBy("_j_uid").agg(
        F.min_by(row, F.xxhash64(F.to_json(row))).alias("_j_row")))
    return kept.unionByName(one.select("_j_row.*"))
