"""Fitted operators: held-out accuracy, exact round trips, defined results on
awkward tables; the pipeline against its operators' brute-force results."""

import html as markup
import random
import re
import struct

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from triploom.llm import bpe, html_text, langid, quality_model
from triploom.llm.queries import TOKENIZER, queries, table

SMALL = SF["0.001"]


# ------------------------------------------------------------------ bpe ---

@pytest.fixture(scope="module")
def encoder():
    return bpe.PrefixEncoder(bpe.read_tokenizer(TOKENIZER))


def awkward_texts():
    rnd = random.Random(1)
    alphabet = "aAbé Üß \n\t\r\x0b\x1c\x85\xa0　'sтп中文😀１2½_-the ing"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
             for _ in range(1500)]
    return texts + [None, "", " ", "\x00﻿", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y",
                    "a" * 30_000, " " * 9_000 + "x", "the" * 9_000, "é" * 5_000, "9" * 5_000]


def test_encoding_equals_the_tokenizers_library(encoder):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(TOKENIZER)
    for text in awkward_texts():
        want = known.encode(text or "", add_special_tokens=False).ids
        ids = encoder.encode(text)
        assert ids == struct.pack(f"<{len(want)}I", *want), repr(text)[:80]
        assert encoder.decode(ids) == known.decode(want, skip_special_tokens=False)


def test_small_caches_change_nothing(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "PAIR_ENTRIES", 5)
    other = bpe.PrefixEncoder(bpe.read_tokenizer(TOKENIZER))
    for text in awkward_texts()[:200]:
        assert other.encode(text) == encoder.encode(text)


def test_bpe_columns_round_trip(spark):
    rows = [(i, t, "kept") for i, t in enumerate(awkward_texts()[-60:])] + [(1, "again", "kept")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    back = bpe.bpe_decode(bpe.bpe_encode(docs, TOKENIZER, ids_col="tokens"), TOKENIZER,
                          ids_col="tokens")
    assert back.columns == [*docs.columns, "tokens", "decoded"]
    for r in back.withColumn("n", bpe.n_tokens(F.col("tokens"))).collect():
        assert r["decoded"] == (r["text"] or "") and r["n"] * 4 == len(r["tokens"])
        assert r["ids"] == "kept"
    assert bpe.bpe_encode(docs.limit(0), TOKENIZER).count() == 0


# ----------------------------------------------------------- language id ---

def test_language_of_held_out_documents(spark):
    got = queries()["op3_language"](spark, SF["0.01"]).collect()
    truth = {r["doc_id"]: r["lang"] for r in table(spark, SF["0.01"], "documents").collect()}
    import zlib
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in {*truth.values(), "und"}
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97


def test_language_of_awkward_rows(spark):
    texts = ["der Hund und die Katze", "le chien et la souris", None, "", "12 34 !?", "x" * 200_000]
    rows = [(i, t, lang, "clash") for i, (t, lang) in enumerate(
        [(texts[0], "de"), (texts[1], "fr"), (None, "de"), ("", None), ("12", "fr"),
         (texts[0], "de"), (texts[1], "fr"), (texts[1], None)] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    model = langid.train(docs)
    assert model.labels == ["de", "fr"]
    new = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = [(r["lang_pred"], r["score"]) for r in langid.identify(new, model).orderBy("doc_id")
           .collect()]
    assert [g[0] for g in got[:5]] == ["de", "fr", "und", "und", "und"]
    assert got[2][1] == 0 and got[5][0] in ("de", "fr")
    assert langid.identify(new.limit(0), model).count() == 0
    for empty in (docs.limit(0), docs.filter("lang is null")):
        none = langid.train(empty)
        assert {r["lang_pred"] for r in langid.identify(new, none).collect()} == {"und"}
    one = langid.train(docs.filter("lang = 'de'"))
    assert {r["lang_pred"] for r in langid.identify(new, one).collect()} == {"de", "und"}


def test_ftrl_weights_are_sparse_and_separate():
    rnd = np.random.default_rng(0)
    rows, y = [], []
    for k in range(300):
        label = k % 2
        at = np.unique(np.concatenate([rnd.integers(0, 50, 10) + 100 * label,
                                       rnd.integers(1000, 1200, 10)]))
        rows.append((at, np.ones(len(at)) / np.sqrt(len(at))))
        y.append(label)
    w = langid.train_ftrl(rows, np.array(y), 2)
    assert (w == 0).mean() > 0.9
    assert all((x @ w[at] + w[-1]).argmax() == label for (at, x), label in zip(rows, y))


# ------------------------------------------------------------ html text ---

def article_by_force(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [re.sub(r"\s+", " ", markup.unescape(re.sub(r"<[^>]*>", "", b))).strip()
              for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_pages_give_their_article(spark):
    got = {r["page_id"]: r for r in queries()["op7_html_text"](spark, SF["0.01"]).collect()}
    for r in table(spark, SF["0.01"], "pages").collect():
        want = article_by_force(r["html"])
        assert got[r["page_id"]]["text"] == want
        assert got[r["page_id"]]["n_chars"] == len(want)


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.train(table(spark, SF["0.01"], "pages"))


def test_layouts_without_semantic_tags(trees):
    page = ("<html><head><title>T</title><script>if (a < b) document.write('<p>no</p>')</script>"
            "</head><body><div class='site-header'><h1>Site name</h1></div>"
            "<div class='menu'><a href=x>Home</a> <a href=y>About</a></div>"
            "<div class='post-content'><h1>Title here</h1><p>First paragraph of the article, "
            "with quite some text &amp; more in it,   as articles\nhave.</p><div class='ad-box'>"
            "Buy this now, it is very cheap.</div><p>Second paragraph of the article&nbsp;with "
            "more text.<ul><li>one item of it<li>two items of it</ul></div><div class='sidebar'>"
            "<h3>Related</h3><p>Some other story that you may like to read.</p></div>"
            "<div id='comments'><div class='comment'><p>I think this is a great article.</p></div>"
            "</div><form><label>Email</label><input><button>Go</button></form>"
            "<div class='cookie-notice'><p>We use cookies to make it better.</p></div>"
            "<footer>&copy; 2020 Site")
    assert html_text.main_text(page, trees).split("\n\n") == [
        "Title here", "First paragraph of the article, with quite some text & more in it, as "
        "articles have.", "Second paragraph of the article with more text.", "one item of it",
        "two items of it"]


def test_decoding_never_contradicts(trees):
    rnd = random.Random(2)
    nodes = [html_text.Node("html", -1, 0)]
    for k in range(1, 60):
        p = rnd.randrange(k)
        nodes.append(html_text.Node("div", p, nodes[p].depth + 1))
    for _ in range(20):
        odds = np.array([rnd.gauss(0, 2) for _ in nodes])
        keep = html_text.decode(nodes, odds)
        assert all(keep[v.parent] for k, v in enumerate(nodes) if keep[k] and v.parent >= 0)
        best = max(0.0, _best(nodes, odds, 0))
        assert odds[keep].sum() == pytest.approx(best)


def _best(nodes, odds, k):
    return odds[k] + sum(max(0.0, _best(nodes, odds, c)) for c, v in enumerate(nodes)
                         if v.parent == k)


def test_broken_pages_and_empty_tables(spark, trees):
    pages = [None, "", "plain text only", "<p>a<b>b", "<div class='x", "<!-- never closed <p>x",
             "<script>x", "&am &#x; &copy &lt;p&gt;", "<p>" * 500 + "deep", "</p></div></html>x",
             "<div>" * 3000 + "<p>very deep", "<a href='q\">text</a><p>more", "<p/>x<br/>y"]
    for p in pages:
        assert isinstance(html_text.main_text(p, trees), str)
    df = spark.createDataFrame([(i, p, "u") for i, p in enumerate(pages)],
                               "page_id long, html string, text string")
    out = html_text.extract_text(df, trees)
    assert out.columns == df.columns and out.count() == len(pages)
    assert html_text.train(df.limit(0)) is None
    assert html_text.extract_text(df.limit(0), None).count() == 0
    assert {r["text"] for r in html_text.extract_text(df, None).collect()} == {""}


# -------------------------------------------------------- quality model ---

def test_quality_of_labelled_documents(spark):
    docs = table(spark, SF["0.1"], "documents")
    labels = table(spark, SF["0.1"], "labels")
    # the labels of every fourth document are held out
    shown = labels.filter("doc_id % 4 <> 0")
    got = quality_model.score_documents(docs, shown, carry=["doc_id"]).join(
        labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    right = [r["kept"] == (r["quality"] == 1) for r in got]
    assert len(got) > 800 and np.mean(right) > 0.98
    good = [r["kept"] for r in got if r["quality"] == 1]
    assert np.mean(good) > 0.99
    assert all(0 <= r["score"] <= 1 for r in got)


def test_quality_awkward_tables(spark):
    rows = [(i, t, None if i % 2 else "en", None, None, "x", "y") for i, t in enumerate(
        [None, "", "  \n", "w " * 100_000, "fine words here"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long, kept string, length string")
    labels = spark.createDataFrame([(0, 1), (1, None), (0, 1), (99, 0)],
                                   "doc_id long, quality int")
    out = quality_model.score_documents(docs, labels)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "length", "text_score",
                           "meta_score", "score", "kept"]
    assert out.count() == len(rows)
    assert quality_model.score_documents(docs.limit(0), labels).count() == 0
    none = quality_model.score_documents(docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}


# -------------------------------------------------------------- pipeline ---

def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline
    from llm_force import contamination_by_force, jaccard_by_force, spans_by_force

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "jaccard_join", "decontaminate", "pii", "bpe"]
    docs = table(spark, SMALL, "documents")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    bench = [(r["item_id"], r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        after = {r["doc_id"]: r for r in out.collect()}
        if name != "bpe":
            assert out.columns == columns
        ids = sorted(before)
        texts = [before[i]["text"] for i in ids]
        if name == "quality_rules":
            short = {i for i in ids if len((before[i]["text"] or "").split()) < 20}
            assert not short & set(after) and len(after) > 0.7 * len(ids)
        elif name == "jaccard_join":
            assert set(after) == {ids[c] for _, c in jaccard_by_force(texts).values()}
        elif name == "decontaminate":
            hits = contamination_by_force(texts, bench)
            assert set(after) == {i for k, i in enumerate(ids) if not hits[k][1]}
        elif name == "pii":
            for i in ids:
                left = after[i]["text"]
                for a, _, b in spans_by_force(before[i]["text"]):
                    assert before[i]["text"][a:b] not in left
                assert after[i]["n_chars"] == len(left)
        else:
            assert all(r["round_trip"] and r["n_tokens"] * 4 == len(r["ids"])
                       for r in after.values()) and set(after) == set(before)
        docs, before = spark.createDataFrame(out.collect(), out.schema), after
    whole = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert whole == {i: r["n_tokens"] for i, r in before.items()}


