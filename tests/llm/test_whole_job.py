"""Whole-job cases: what the operators did in part before."""

import random

import numpy as np
from llm_force import WORD
from pyspark.sql import functions as F

from triploom.llm import html_text, jaccard_join, quality_rules, suffix_repeats

# -------------------------------------------------------- quality rules ---


def mcd_by_force(x):
    """Squared distances by the best of many concentrated halves."""
    rnd, best = np.random.default_rng(1), (np.inf, None, None)
    for k in range(200):
        own = x[rnd.choice(len(x), x.shape[1] + 2, replace=False)]
        for _ in range(20):
            m, c = own.mean(0), np.cov(own.T) + 1e-9 * np.eye(x.shape[1])
            d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            own = x[np.argsort(d2)[:len(x) // 2 + 1]]
        best = min(best, (np.linalg.det(np.cov(own.T)), k, own), key=lambda b: b[0])
    m, c = best[2].mean(0), np.cov(best[2].T)
    d2 = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    return d2 * 5.348 / np.median(d2)


def test_quality_verdict_against_brute_force_mcd(spark):
    rnd = random.Random(9)
    stems = "ti on the er a re ha ing st le nd ou".split()
    word = lambda: "".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4)))

    def clean():
        said = [word() for _ in range(rnd.randint(150, 500))]
        return " ".join(w.capitalize() + "," if k % 9 == 0 else w for k, w in enumerate(said))

    good = [clean() for _ in range(120)]
    # a few good ones hold numbers, which most don't
    good += [clean() + f" call {k}55 0{k}02 now" for k in range(6)]
    tables = [" | ".join(word() for _ in range(250)) for _ in range(6)]
    symbols = [" ".join(word() + rnd.choice(["###", "$$$", "%%%"]) for _ in range(250))
               for _ in range(6)]
    texts = good + tables + symbols
    rows = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge_documents(rows, carry=["doc_id"]).collect()}
    bad = range(len(good), len(texts))
    assert all(got[k]["_q_kept"] for k in range(len(good)))
    assert not any(got[k]["_q_kept"] for k in bad)
    # the estimate decides: as in brute force over the statistics that vary,
    # half of the distances are below the chi-square median
    assert abs(np.median([r["_q_distance"] for r in got.values()]) - 5.348) < 0.3
    words = [WORD.findall(t) for t in texts]
    x = np.array([(np.log(sum(map(len, w)) / len(w)), np.log(len(set(w))) / np.log(len(w) + 1))
                  for w in words])
    force = mcd_by_force(x)
    far = [k for k in bad if force[k] > quality_rules.CUT]
    assert far and not any(got[k]["_q_kept"] for k in far)
    assert all(got[k]["_q_kept"] for k in range(len(good)) if force[k] < quality_rules.FIRST_CUT)


def test_quality_of_labelled_good_and_bad_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality_rules.judge_documents(docs, carry=["doc_id"]).join(labels, "doc_id")
    rows = judged.filter(~F.col("_q_base_failed")).collect()
    good = [r["_q_kept"] for r in rows if r["quality"] == 1]
    bad = [r["_q_kept"] for r in rows if r["quality"] == 0]
    assert len(bad) > 20 and np.mean(good) > 0.99 and np.mean(bad) < 0.05


# ----------------------------------------------- null and repeated ids ---

ID_DOCS = "doc_id long, text string, extra string"


def test_one_row_of_each_component_is_kept_whatever_the_ids(spark):
    base = [f"b{i}" for i in range(120)]
    near = base[:60] + ["edit"] + base[61:]
    other = [f"o{i}" for i in range(90)]
    rows = [(5, " ".join(base), "x"), (5, " ".join(base), "x"), (5, " ".join(other), "x"),
            (None, " ".join(near), "y"), (None, " ".join(base), "y"),
            (2**60 + 1, " ".join(other), "z"), (None, " ".join(f"n{i}" for i in range(70)), "1"),
            (None, " ".join(["first"] + [f"n{i}" for i in range(1, 70)]), "2"),
            (7, None, "e"), (8, "", "e"), (None, None, "e")]
    table = spark.createDataFrame(rows, ID_DOCS).repartition(3)
    kept = jaccard_join.keep_one(table)
    assert kept.columns == table.columns
    got = [(r["doc_id"], (r["text"] or "")[:1]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted(
        [(5, "b"), (5, "o"), (None, got[[x[1] in "nf" and x[1] != "" for x in got].index(True)][1]),
         (7, ""), (8, ""), (None, "")], key=str)
    found = {(r["doc_id"], r["n"], r["component"])
             for r in jaccard_join.jaccard_components(table).collect()}
    assert {(None, 117, 5), (2**60 + 1, 87, 5), (5, 117, 5), (None, 67, None)} <= found


def test_repeats_of_null_and_repeated_ids(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    own = " ".join(f"q{i}" for i in range(60))
    rows = [(None, passage + " tail", "a"), (3, passage, "b"), (None, passage + " end", "c"),
            (2**60 + 1, own, "d"), (2**60 + 1, own, "d"), (4, "short", "e"), (4, None, "e")]
    table = spark.createDataFrame(rows, ID_DOCS).repartition(3)
    cut = suffix_repeats.remove_repeats(table)
    texts = [r["text"] for r in cut.collect()]
    # one copy of each passage is left
    assert len(texts) == len(rows) and sum("p7 " in (t or "") for t in texts) == 1
    assert sum("q7 " in (t or "") for t in texts) == 1
    assert {(r["doc_id"], len(r["removable"])) for r in suffix_repeats.repeated_spans(
        table).collect()} >= {(3, 1), (2**60 + 1, 0), (2**60 + 1, 1)}


# ------------------------------------------------------------ html text ---

def shown(page):
    return " ".join(b for v in html_text.read_page(page) for b in html_text._own_blocks(v)
                    if isinstance(b, str))


def test_hidden_elements_nest_and_end_as_others_do():
    assert shown("<p hidden>x<p>Main text</p>") == "Main text"
    assert shown("<ul><li hidden>x<li>one</ul><p>Main") == "one Main"
    assert shown("<table><tr><td hidden>x<td>y<tr><td>z</table><p>Main") == "y z Main"
    page = "<div><div style='display: none'><div>a</div>b</div><p>in</p></div><p>out</p>"
    assert shown(page) == "in out"
    nodes = html_text.read_page(page)
    assert [(v.tag, v.depth) for v in nodes] == [("html", 0), ("div", 1), ("p", 2), ("p", 1)]
    assert shown("<div><span hidden>x</div><p>Main") == "Main"
    assert shown("<svg><svg></svg>a</svg>b<template><template></template>c</template>d") == "bd"
    assert shown("<p>a<svg><text>x<p>Main</p>") == "a Main"
    # a slash at a tag's end closes nothing but an element of a drawing
    assert shown("<p>a</p><script src=/js/>var a=1;</script><p>b</p>") == "a b"
    assert shown('<style media="all"/>p{color:red}</style><p>b</p>') == "b"
    assert shown("<div data-u=/x/><p>a</p></div><p>b</p>") == "a b"
    assert shown("<div><div/>a</div>b</div>c") == shown("<div><div>a</div>b</div>c")
    assert shown("<p>a<svg><path d=1 /><g/></svg>b</p>") == "ab"
    nodes = html_text.read_page("<ul><li><a href=/a/>Home page</a></li></ul><p>text</p>")
    assert sum(v.links for v in nodes) == len("Home page")
    assert shown("<p>a <b hidden>x</b>c") == "a c"
    assert shown("<div>a<object>x</div>y</object>b</div>") == "ab"


def test_what_only_screen_readers_skip_is_shown():
    nodes = html_text.read_page("<div aria-hidden='true'><p>Main</p></div>")
    assert shown("<div aria-hidden='true'><p>Main</p></div>") == "Main"
    assert nodes[1].tokens == ("unread",)


def test_digits_of_whole_blocks():
    nodes = html_text.read_page("<div>" + "a" * 300 + "1" * 100 + "<p>x</p>" + "2" * 400 + "</div>")
    rows = html_text.node_features(nodes, [html_text._own_blocks(v) for v in nodes])
    assert rows[1, html_text.FEATURES.index("digits")] == 500 / 800


def test_a_page_of_many_megabytes_is_read_whole():
    words = " ".join(f"word{i}" for i in range(60_000))
    page = "<div id=x/>" + f"<p>{words}</p>" * 12 + "<script src=a/>x</script></div><p>end</p>"
    text = shown(page)
    assert len(page) > 6_000_000 and text.count("word59999") == 12 and text.endswith("end")
    assert "script" not in text and " x" not in text
