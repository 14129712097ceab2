"""Word-based operators against brute force on small, awkward tables."""

import collections
import math
import re

import pytest
from llm_force import WORD, contamination_by_force, jaccard_by_force, luhn, spans_by_force
from pyspark.sql import functions as F

from triploom.llm import chat, decontaminate, jaccard_join, pii, quality_rules, suffix_repeats

LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n string, scale string"


def docs(spark, texts):
    """Documents with columns whose names clash with common internal ones."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", len(t or ""), "x", "y")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# -------------------------------------------------------- decontaminate ---

BENCH = [(1, "the Quick brown fox jumps over the lazy dog and then sleeps all day"), (2, None),
         (3, ""), (4, "Ünder drei"), (10, "the quick brown fox jumps over the lazy dog and"),
         (4, "Ünder drei"), (5, "a a a a a a a a a a a a")]
TEXTS1 = [None, "", "   \n", "nothing here", "The QUICK brown-fox jumps over the lazy dog, and then",
          "so Ünder  drei ünder drei", "a " * 13, LONG, "quick brown fox",
          "x the quick brown fox jumps over the lazy dog and then sleeps all day y",
          "x the quick brown fox jumps over the lazy dog and then sleeps all day y"]


@pytest.mark.parametrize("limit", [decontaminate.MAX_BROADCAST_BYTES, 300])
def test_contamination_matches_brute_force(spark, limit):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    got = decontaminate.contamination(docs(spark, TEXTS1), bench, max_broadcast_bytes=limit)
    got = {r["doc_id"]: (r["_n_words"], len(r["_hits"] or []), r["_items"] or [])
           for r in got.collect()}
    assert got == contamination_by_force(TEXTS1, BENCH)


def test_decontaminate_removes_documents_or_spans(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    table = docs(spark, TEXTS1)
    kept = decontaminate.decontaminate(table, bench)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 3, 7, 8}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(
        table, bench, remove="span").collect()}
    assert cut[9] == "x  y" and cut[4] == "" and cut[7] == LONG and cut[0] is None
    assert cut[5] == "so  ünder drei"   # the gaps around the span stay


def test_decontaminate_empty_tables(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    assert decontaminate.decontaminate(docs(spark, TEXTS1), bench.limit(0)).count() == len(TEXTS1)
    assert decontaminate.contamination(docs(spark, TEXTS1).limit(0), bench).count() == 0


# ----------------------------------------------------------------- chat ---

CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "<s>[INST] \\ back\\\\slash </s>"),
    (2, 0, "system", None), (2, 1, "user", ""), (2, 2, "assistant", "ok\nok"),
    (3, 0, "assistant", "first"), (3, 1, "user", "late"),
    (4, 0, "tool", "[ROLE]x[SAYS]y[/ROLE]"), (4, 1, None, "none"),
    (5, 5000, "user", "far"), (5, 9000, "assistant", "apart"),
    (6, 0, "user", "same"), (6, 0, "user", "same"), (None, None, "user", "null"),
]


def test_chat_round_trip_and_order(spark):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string") \
        .withColumn("block", F.lit("clash")).withColumn("segments", F.lit(1))
    out = chat.chat_format(rows, block_turns=4).select(
        "conv_id", "valid", "n_turns", "formatted", chat.read_turns(F.col("formatted"))
        .alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    got = {r["conv_id"]: r for r in out.collect()}
    want = collections.defaultdict(list)
    for c, t, role, text in CHATS:
        want[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns = sorted(turns)
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [x[1:] for x in turns]
        assert got[c]["loss"] == "".join(x[2] for x in turns if x[1] == "assistant")
        assert got[c]["n_turns"] == len(turns)
    assert {c for c, r in got.items() if r["valid"]} == {1, 2, 5}
    segments = chat.chat_segments(rows).filter("conv_id = 1").orderBy("turn", "segment").collect()
    assert "".join(s["text"] for s in segments) == got[1]["formatted"]
    assert [s["loss"] for s in segments] == [False] * 4 + [True, False]
    assert chat.chat_format(rows.limit(0)).count() == 0


# ------------------------------------------------------------------ pii ---

TEXTS5 = [
    None, "", "nothing", "a@b.co", "a@b.c_d@e.f x@y", "é😀 me.x+y@mail-1.example.com, you@@b.c",
    "1.2.3.4 999.1.2.3.4 1.2.3.4.5.6.7.8 007.08.9.255 1.2.3 256.1.1.1", "4111 1111 1111 1111",
    "4111-1111-1111-1112 and 4111 1111 1111 1111 1111 1111", "1 4 4111111111111111 3",
    "+1 (717) 555-0202, +49 30 123 and ++1-2-3-4-5-6-7-8-9", "+1" + " " * 500 + "2",
    "call 717 555 0202 or write to me (at) mail.example.com please", "x" * 200_000 + "@",
    "1" * 50_000, "a@" + "b." * 20_000 + "c", "1.2.3.4 " * 300, "a@b.co\na@b.co",
]


def test_base_spans_match_brute_force(spark):
    got = pii.find_spans(docs(spark, TEXTS5), carry=["doc_id"]).collect()
    for r in got:
        want = spans_by_force(TEXTS5[r["doc_id"]])
        assert [(s["start"], s["kind"], s["end"]) for s in r["_p_base"]] == want, r["doc_id"]
        spans = [(s["start"], s["kind"], s["end"]) for s in r["_p_spans"]]
        assert set(want) <= set(spans)


def test_redact(spark):
    table = docs(spark, TEXTS5)
    out = pii.redact(table)
    assert out.columns == table.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[3] == "<EMAIL>" and got[0] is None and got[1] == "" and got[2] == "nothing"
    assert got[17] == "<EMAIL>\n<EMAIL>" and got[7] == "<CARD>"
    assert pii.redact(table.limit(0)).count() == 0
    assert pii.redact(table.filter("doc_id < 3")).count() == 3


def test_votes_estimate_separates_good_from_bad():
    counts = {"card": {"+++0": 900, "++-0": 60, "--+0": 200, "---0": 700, "---+": 3}}
    reliability, posterior = pii.estimate_votes(counts)
    assert posterior["card|+++0"] > 0.95 and posterior["card|---0"] < 0.05
    assert reliability["card"][0] > 0.9


def planted(n=60):
    """Texts with one further span or one decoy each, beside base spans."""
    import random
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(3, 8)))
    words = lambda: " ".join(word() for _ in range(rnd.randint(3, 12)))
    digits = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    hexes = lambda k: "".join(rnd.choice("0123456789abcdef") for _ in range(k))

    def card(good):
        while True:
            d = ("4" if good else rnd.choice("01789")) + digits(15)
            if luhn(d) == good:
                return d

    out = []                # text, (start, kind, end) or None, whether to be found
    for _ in range(n):
        base = rnd.choice([f"{word()}@{word()}.com", f"8.{rnd.randint(1, 250)}.7.9", card(True),
                           f"+1 (717) 555-{digits(4)}"])
        for kind, lead, span, found in [
                (0, "", f"{word()}.{word()} (at) {word()}.example.com", True),
                (1, "", ":".join(["2001"] + [hexes(4) for _ in range(7)]), True),
                (3, "", f"({rnd.randint(201, 989)}) {rnd.randint(201, 989)}-{digits(4)}", True),
                (4, 'token = "', hexes(40), True), (4, "api_key='", digits(1) + "aB" + hexes(27), True),
                (2, "", card(False), False), (1, "", f"{rnd.randint(256, 999)}.4.3.{digits(2)}", False),
                (4, "commit: ", hexes(40), False), (3, "", "000 " + digits(3) + " " + digits(4), False)]:
            text = f"{words()} {lead}"
            at = len(text)
            close = lead[-1] if lead[-1:] in ("'", '"') else ""
            out.append((f"{text}{span}{close} {words()} {base} {words()}.",
                        (at, kind, at + len(span)), found))
    return out


def test_added_spans_of_a_planted_table(spark):
    rows = planted()
    found = pii.find_candidates(docs(spark, [t for t, _, _ in rows])).cache()
    model = pii.fit(found)
    right = wrong = missed = 0
    for r in pii.choose_spans(found, model).collect():
        text, span, wanted = rows[r["doc_id"]]
        base = spans_by_force(text)
        added = {tuple(s) for s in r["_p_spans"]} - set(base)
        assert [tuple(s) for s in r["_p_base"]] == base
        right += wanted and span in added
        missed += wanted and span not in added
        wrong += len(added - ({span} if wanted else set()))
    print("added spans:", right, "right,", wrong, "wrong,", missed, "missed")
    assert right >= 0.95 * (right + missed) and right >= 0.95 * (right + wrong)


def test_span_classifier_matches_plain_counts(spark):
    found = pii.find_candidates(docs(spark, [t for t, _, _ in planted(10)]))
    model = pii.fit(found.cache())
    spans = [c for r in found.collect() for c in r["_p_found"]]
    patterns = collections.defaultdict(collections.Counter)
    for c in spans:
        patterns[c["votes"].split("|")[0]][c["votes"].split("|")[1]] += 1
    _, p = pii.estimate_votes(patterns)
    for kind in patterns:
        mine = [c for c in spans if c["votes"].startswith(kind + "|")]
        yes = sum(p[c["votes"]] for c in mine)
        no = len(mine) - yes
        assert abs(model.bias[kind] - math.log((yes + 0.5) / (no + 0.5))) < 1e-6
        for f in {f for c in mine for f in c["features"]}:
            have = [p[c["votes"]] for c in mine if f in c["features"]]
            pull = pii.PULL * len(have) / len(mine)
            want = (math.log((sum(have) + pull) / (yes + pii.PULL))
                    - math.log((len(have) - sum(have) + pull) / (no + pii.PULL)))
            assert abs(model.weights[f] - want) < 1e-6, f
        assert not any("vote" in f for c in mine for f in c["features"])


def test_every_labeler_votes(spark):
    from triploom.llm.queries import table
    found = pii.find_candidates(table(spark, "/root/testdata/sf0.01", "documents"))
    votes = [r["v"] for r in found.select(F.explode("_p_found.votes").alias("v")).collect()]
    for kind in pii.KINDS:
        mine = [v.split("|")[1] for v in votes if v.startswith(kind + "|")]
        # the usual form abstains on hexadecimal values, all that secrets are here
        assert mine and all(any(v[j] != "0" for v in mine)
                            for j in range(kind == "secret", 3)), kind


def test_secrets_are_redacted(spark):
    secret = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f'in words token = "{secret[i:] + secret[:i]}" and more words' for i in range(30)]
    got = [r["text"] for r in pii.redact(docs(spark, texts)).collect()]
    assert got == ['in words token = "<SECRET>" and more words'] * 30


# -------------------------------------------------------- quality rules ---

def statistics_by_force(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n, covered = collections.Counter(windows), set()
    for i, x in enumerate(windows):
        if n[x] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_quality_statistics_and_outliers(spark):
    import random
    rnd = random.Random(5)
    stems = ["ti", "on", "the", "er", "a", "re", "ha", "ing", "st", "le"]
    word = lambda: "".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4)))
    clean = [" ".join(word() for _ in range(rnd.randint(30, 300))) for _ in range(120)]
    odd = [" ".join(word() + "###$$" for _ in range(300)) for _ in range(4)]
    rest = [None, "", "one", "a b c d e f g h\na b c d e f g h\n\n \n", "é " * 40, LONG,
            " ".join(["x y z"] * 50), clean[0]]
    texts = clean + odd + rest
    table = docs(spark, texts).withColumn("source", F.lit("s")).withColumn("lang", F.lit("en"))
    out = quality_rules.judge_documents(table, min_group=30)
    assert out.columns[:7] == table.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for k, text in enumerate(texts):
        r = got[k]
        want = statistics_by_force(text)
        assert tuple(r[f"_q_{n}"] for n in quality_rules.BASE) == want, k
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r["_q_base_failed"] == failed and (not failed or not r["_q_kept"])
        assert r["n"] == "x" and r["scale"] == "y" and r["text"] == text
    assert all(got[k]["_q_kept"] for k in range(120))
    assert not any(got[k]["_q_kept"] for k in range(120, 124))
    kept = quality_rules.filter_documents(table, min_group=30)
    assert kept.columns == table.columns
    assert quality_rules.filter_documents(table.limit(0)).count() == 0
    # null groups, all too small for an estimate: only the base rules decide
    few = quality_rules.judge_documents(docs(spark, clean[:5] + [None])).collect()
    assert [r["_q_kept"] for r in sorted(few, key=lambda r: r["doc_id"])] == [True] * 5 + [False]


# ---------------------------------------------------------- near copies ---

def near_copies():
    import random
    rnd = random.Random(3)
    texts = [None, "", " \n", "one two", "One  TWO", "one two three", "É x", "é x", LONG,
             LONG + " more words here"]
    for base_words, copies, edits in ((60, 14, 1), (200, 25, 4), (30, 8, 1), (400, 12, 12)):
        base = [f"b{rnd.randint(0, 400)}" for _ in range(base_words)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = f"e{rnd.randint(0, 9999)}"
            texts.append(" ".join(w))
    passage = [f"p{i}" for i in range(50)]
    for k in range(40):   # a passage that many otherwise different texts share
        own = [f"o{k}_{i}" for i in range(rnd.randint(3, 90))]
        texts.append(" ".join(own[:2] + passage + own[2:]))
    return texts + texts[5:20]


@pytest.mark.parametrize("frequent", [jaccard_join.FREQUENT_LEAST, 4])
def test_jaccard_components_match_brute_force(spark, monkeypatch, frequent):
    # with a low limit, copies and shared passages take the combination path
    monkeypatch.setattr(jaccard_join, "FREQUENT_LEAST", frequent)
    monkeypatch.setattr(jaccard_join, "LOCAL_LEAST", min(4, frequent))
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    texts = near_copies()
    table = docs(spark, texts).repartition(2)
    got = {r["doc_id"]: (r["n"], r["component"])
           for r in jaccard_join.jaccard_components(table).collect()}
    want = jaccard_by_force(texts)
    assert got == want
    kept = jaccard_join.keep_one(table)
    assert kept.columns == table.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in want.values()}


def test_jaccard_empty(spark):
    assert jaccard_join.jaccard_components(docs(spark, ["x"]).limit(0)).count() == 0


# ------------------------------------------------------------- repeats ---

def repeats_by_force(texts, least):
    count, first = collections.Counter(), {}
    windows = []
    for k, t in enumerate(texts):
        w = WORD.findall(t or "")
        windows.append([tuple(w[i:i + least]) for i in range(len(w) - least + 1)])
        for i, x in enumerate(windows[-1]):
            count[x] += 1
            first.setdefault(x, (k, i))

    def spans(starts):
        out = []
        for s in starts:
            if out and s <= out[-1][1]:
                out[-1][1] = s + least
            else:
                out.append([s, s + least])
        return out

    out = {}
    for k, ws in enumerate(windows):
        every = spans([i for i, x in enumerate(ws) if count[x] > 1])
        if every:
            out[k] = (every, spans([i for i, x in enumerate(ws)
                                    if count[x] > 1 and first[x] != (k, i)]))
    return out


@pytest.mark.parametrize("least,anchor", [(50, 17), (12, 4)])
def test_repeated_spans_match_brute_force(spark, least, anchor):
    import random
    rnd = random.Random(4)
    passages = [[f"p{k}_{rnd.randint(0, 50)}" for _ in range(n)]
                for k, n in enumerate((49, 50, 51, 80, 200, 12, 11))]
    texts = [None, "", "short", "a " * 120, LONG]
    for k in range(40):
        w = [f"u{k}_{i}" for i in range(rnd.randint(0, 120))]
        for p in rnd.sample(passages, rnd.randint(0, 3)):
            at = rnd.randint(0, len(w))
            cut = rnd.randint(0, 4)
            w[at:at] = p[cut:] if rnd.random() < 0.4 else p
        texts.append(" ".join(w))
    texts += [" ".join(f"v{i}" for i in range(90))] * 2
    table = docs(spark, texts).repartition(3)
    got = {r["doc_id"]: (r["spans"], r["removable"]) for r in suffix_repeats.repeated_spans(
        table, least=least, anchor=anchor).collect()}
    assert got == repeats_by_force(texts, least)
    cut = suffix_repeats.remove_repeats(table, least=least, anchor=anchor)
    assert cut.columns == table.columns
    left = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert left[len(texts) - 1] == "" and left[len(texts) - 2] == texts[-1]
    assert left[0] is None and left[4] == LONG


def test_repeats_empty(spark):
    assert suffix_repeats.repeated_spans(docs(spark, ["x"]).limit(0)).count() == 0


