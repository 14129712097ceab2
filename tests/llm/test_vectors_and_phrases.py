"""Operators 11 to 13 against brute force on small, awkward tables."""

import math
import time
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from triploom.llm import collocations, hard_negatives, posting_lists, vectors
from triploom.llm.queries import queries

VEC = "vec_id long, embedding array<double>, label int, vector string, list string, score int"
AWKWARD = [(None, [1.0, 2.0, 3.0], 1), (900_001, None, 1), (900_002, [], 2),
           (900_003, [1.0, None, 2.0], 3), (900_004, [1.0, float("nan"), 2.0], 1),
           (900_005, [1.0, float("inf"), 0.0], 1), (900_006, [1.0, 2.0], 1)]


def vec_table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows], VEC)


def grid(n, dim=3, labels=4):
    """Vectors with many equal inner products, repeated vectors and zeros."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (n, dim)).astype(float) / 4
    x[::9] = x[0]
    return [(i, x[i].tolist(), int(rng.integers(0, labels))) for i in range(n)]


# ------------------------------------------------------------ posting lists ---

def nearest_by_force(rows, k):
    out = []
    for q, v, _ in rows:
        if q % 20 or not any(v):
            continue
        found = sorted((-sum_in_order(v, w), i) for i, w, _ in rows if i != q and any(w))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out)


def sum_in_order(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def test_nearest_is_exact_where_all_lists_are_searched(spark):
    rows = grid(300)
    table = vec_table(spark, rows + rows[:40] + AWKWARD)   # repeated rows count once
    got = posting_lists.nearest(table, F.col("vec_id") % 20 == 0, k=7, list_rows=1000)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == nearest_by_force(rows, 7)


def test_nearest_with_few_or_no_rows(spark):
    few = grid(5)
    few[0] = (0, [1.0, 1.0, 1.0], 1)
    got = posting_lists.nearest(vec_table(spark, few), F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == nearest_by_force(few, 20)
    for rows in ([], AWKWARD[1:6], few[:1]):
        assert posting_lists.nearest(vec_table(spark, rows), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_with_pruned_lists_and_uneven_norms(spark, monkeypatch):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 4000)] + 0.3 * rng.normal(size=(4000, 16))
    x *= rng.uniform(0.5, 2.0, (4000, 1))
    x[1000:2000] = x[1000] + 1e-3 * rng.normal(size=(1000, 16))   # a large group of near copies
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    table = vec_table(spark, rows)
    monkeypatch.setattr(vectors, "ROW_BLOCK", 100)     # lists over several blocks
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 10)
    got = {}
    for r in posting_lists.nearest(table, F.col("vec_id") % 20 == 0, list_rows=64).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    truth = {q: set(np.argsort(-s[q], kind="stable")[:20].tolist()) for q in range(0, 4000, 20)}
    assert got.keys() == truth.keys()
    assert np.mean([len(got[q] & truth[q]) / 20 for q in truth]) >= 0.9
    index = posting_lists.fit(vectors.vector_table(table, nonzero=True), list_rows=64)
    held = np.mean([len(p) for p in posting_lists.lists_of_queries(index, x[::20])])
    assert len(index.centroids) == 32 and held < 0.6 * 32    # lists are pruned


def test_lists_are_balanced_and_all_centroids_are_reached():
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(700, 8)), np.zeros((300, 8))])
    c = posting_lists.balanced_centroids(x, 16)
    first, links, entries = posting_lists.centroid_graph(c)
    reached, todo = set(entries), list(entries)
    while todo:
        i = todo.pop()
        new = set(links[first[i]:first[i + 1]]) - reached
        reached |= new
        todo += new
    assert len(c) == 16 and reached == set(range(16))


def test_registered_search_reaches_its_recall(spark):
    sf = "/root/testdata/sf0.1"
    got = {}
    for r in queries()["op11_posting_lists"](spark, sf).collect():
        got.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], float)
    ids = np.array([r["vec_id"] for r in rows])
    truth = posting_lists.exact_nearest(ids, x, [i for i in ids if i % 20 == 0])
    assert got.keys() == truth.keys()
    found = [i in got[q] for q, t in truth.items() for i, _ in t]
    assert np.mean(found) >= 0.9
    assert all(got[q][i] == s for q, t in truth.items() for i, s in t if i in got[q])


# ----------------------------------------------------------- hard negatives ---

def mined_by_force(rows, every=100, quantum=256):
    rows = [(i, [math.floor(quantum * c) for c in v], la) for i, v, la in rows]
    out = []
    for a, v, la in rows:
        if a % every:
            continue
        score = {i: sum(p * q for p, q in zip(v, w)) for i, w, _ in rows}
        label = {i: x for i, _, x in rows}
        order = sorted((i for i in score if i != a), key=lambda i: (-score[i], i))
        for p in [i for i in order if label[i] == la][:5]:
            fits = [n for n in order if label[n] != la
                    and 30 * score[p] <= 100 * score[n] <= 90 * score[p]]
            out += [(a, p, r, n, score[p], score[n]) for r, n in enumerate(fits[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("leaf_rows", [20, 10_000])
def test_mined_negatives_match_brute_force(spark, monkeypatch, leaf_rows):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", leaf_rows)
    monkeypatch.setattr(vectors, "ROW_BLOCK", 50)
    rows = grid(400)
    table = vec_table(spark, rows + rows[:30] + AWKWARD + [(900_007, [0.5, 0.5, 0.5], None)])
    got = hard_negatives.mine(table, F.col("vec_id") % 25 == 0)
    assert sorted(tuple(r) for r in got.collect()) == mined_by_force(rows, 25)


def test_mined_negatives_of_wide_vectors(spark, monkeypatch):
    """Norms differ, components pass 2**24: sums beyond doubles are exact."""
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 30)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 8)) * rng.uniform(1e3, 2e5, (500, 1))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    got = hard_negatives.mine(vec_table(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == mined_by_force(rows, 50)


def test_mined_negatives_of_empty_or_one_label_tables(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [2.0], 1)], AWKWARD):
        assert hard_negatives.mine(vec_table(spark, rows), F.col("vec_id") % 100 == 0).count() == 0


def test_ranges_rule_out_leaves_but_no_row():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    radius2 = float((x ** 2).sum(1).max())
    pad = vectors.padded(x, 1.0, radius2)
    tree = hard_negatives.grow(pad[:500], 1.0, radius2, 2)
    leaf = hard_negatives.leaf_of(tree, pad)
    low = [np.full((p.shape[0], 8, 8), np.inf) for p in tree.points]
    high = [-a for a in low]
    for level, (node, d, child) in enumerate(hard_negatives._paths(tree, pad)):
        for n, ds, c in zip(node, d, child):
            low[level][n, :, c] = np.minimum(low[level][n, :, c], ds)
            high[level][n, :, c] = np.maximum(high[level][n, :, c], ds)
    tree = hard_negatives.Tree(1.0, radius2, tree.points, low, high)
    lows, highs = np.full((20, 1), 2.0), np.full((20, 1), 2.5)
    q, near, far = hard_negatives._annuli(tree, x[:20], lows, highs)
    opened = hard_negatives.open_leaves(tree, q, near, far)
    s = x[:20] @ x.T
    for i in range(20):
        assert set(leaf[(s[i] >= 2.0) & (s[i] <= 2.5)]) <= set(opened[i].tolist())
    assert np.mean([len(o) for o in opened]) < 0.9 * 64


# -------------------------------------------------------------- collocations ---

def phrases_by_force(docs, least=10, best=2000):
    import re
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    out = {}
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        if any(len(q) == 3 and g == lang and p in (q[:2], q[1:]) and b >= least and 2 * b >= a
               for (g, q), b in (f.items() if len(p) == 2 else ())):
            continue
        score, k = min((int(Fraction(10 ** 6 * a * a, f[lang, p[:k]] * f[lang, p[k:]])), k)
                       for k in range(1, len(p)))
        out.setdefault(lang, []).append(
            (-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items()
                  for r, (s, a, p, left, right) in enumerate(sorted(rows)[:best], 1))


def phrase_docs():
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(12)] + ["New", "york", "Été", "ÀB", "x y", "日本"]
    out = [("en" if i % 3 else None, " ".join(words[j] for j in rng.integers(0, 18, 40)))
           for i in range(60)]
    out += [("en", "New York city, NEW york City; new york")] * 40
    out += [("fr", "a a a a a a a a a a a a a a a a"), ("fr", None), ("fr", ""), ("de", " \t,\n!"),
            ("fr", "b\tc  d\x0bb c d\rb\x1cc d" * 9), (None, "." * 50)]
    out += [("long", " ".join(f"t{i % 7}" for i in range(30_000)))]
    return out


@pytest.mark.parametrize("held,best", [(collocations.HELD, 2000), (50, 5)])
def test_collocations_match_brute_force(spark, monkeypatch, held, best):
    monkeypatch.setattr(collocations, "HELD", held)
    rows = phrase_docs()
    docs = spark.createDataFrame([(a, b, 1, "x", "y") for a, b in rows],
                                 "lang string, text string, n int, phrase string, grp string")
    got = collocations.collocations(docs, best=best)
    assert sorted(tuple(r) for r in got.collect()) == phrases_by_force(rows, best=best)


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([("en", None), (None, ""), ("en", "a b")],
                                 "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_collocations_leave_no_shuffle_files_of_their_tables(spark):
    """The shuffles of words and triples start on a disk without the ones before."""
    from triploom.session import FREE_SHUFFLES

    def shuffles():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = manager.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    rows = phrase_docs()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    before = shuffles()
    got = collocations.collocations(docs)
    for _ in range(100):    # files go a moment after their query
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(FREE_SHUFFLES, None) is None
    for _ in range(2):
        assert sorted(tuple(r) for r in got.collect()) == phrases_by_force(rows)


def test_freed_shuffles_restore_the_setting(spark, conf):
    from triploom.session import FREE_SHUFFLES, shuffles_freed

    conf(FREE_SHUFFLES, "false")
    with pytest.raises(ValueError), shuffles_freed(spark):
        assert spark.conf.get(FREE_SHUFFLES) == "true"
        raise ValueError
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_parse_covers_every_phrase_once():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 5, 400):
        words = [f"w{i}".encode() for i in rng.integers(0, 30, n)]
        chunks = list(collocations.parse(b" ".join(words)))
        assert sum(e for _, e in chunks) == (n > 0)
        for k in (1, 2, 3):
            got = []
            for c, last in chunks:
                w = c.split(b" ")
                got += [tuple(w[i:i + k]) for i in range(len(w) - (k - 1 if last else 2))]
            assert got == [tuple(words[i:i + k]) for i in range(n - k + 1)]
    assert len(chunks) > 10


def test_scores_beyond_64_bits_are_exact(spark):
    big = 3_037_000_500 * 10 ** 3
    rows = spark.createDataFrame([("g", "a b", big)], "grp string, phrase string, a long")
    parts = spark.createDataFrame([("g", "a", big + 7), ("g", "b", big + 11)],
                                  "grp string, phrase string, n long")
    got = collocations._cut(rows, parts, 1, 2).first()["score"]
    assert got == 10 ** 6 * big * big // ((big + 7) * (big + 11))


def test_phrases_are_summed_by_number_in_each_task(monkeypatch):
    """Groups, chunk ends and equal words of several batches stay apart."""
    import pyarrow as pa

    names = ["grp", "chunk", "last", "n"]
    rows = [("en", "a b c", False, 2), ("fr", "a b c", True, 5), ("en", "a a a a", True, 3),
            ("en", "é", True, 1), ("fr", "b c", True, 7)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in part], pa.schema(
        [("grp", pa.string()), ("chunk", pa.string()), ("last", pa.bool_()), ("n", pa.int64())]))
        for part in (rows[:2], [], rows[2:])]
    ((words, held),) = collocations.held_words(iter(batches))
    assert len(held) == 2
    monkeypatch.setattr(collocations, "SENT", 2)

    def counted(begins, size):
        sent = list(words.counted(np.flatnonzero(begins), size))
        assert all(b.num_rows <= 2 for b in sent)
        return Counter({(r["grp"], r["phrase"]): r["n"] for b in sent for r in b.to_pylist()})

    assert counted(words.left > 0, 1) == {("en", "a"): 14, ("en", "b"): 2, ("en", "c"): 2,
                                          ("fr", "a"): 5, ("fr", "b"): 12, ("fr", "c"): 12,
                                          ("en", "é"): 1}
    assert counted(words.left > 1, 2) == {("en", "a b"): 2, ("en", "b c"): 2, ("en", "a a"): 9,
                                          ("fr", "a b"): 5, ("fr", "b c"): 12}
    assert counted(words.left > 2, 3) == {("en", "a b c"): 2, ("en", "a a a"): 6,
                                          ("fr", "a b c"): 5}
