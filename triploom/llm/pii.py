"""Personal data: labelers vote on candidate spans, expectation-maximisation
weighs them, and a span classifier trained on the outcome decides.

Base spans (email, ip, card, phone) follow fixed patterns and always stay.
Wider patterns add candidates: obfuscated addresses, local phone numbers,
long addresses, digit runs and dotted or dialled numbers that fail a base
test, and secrets (values of assignments, keys with a known head). Three
labelers vote +1, 0 or -1 on every candidate: a pattern of how such a thing
is usually written (numbers that break a check digit or a range aren't; the
other base patterns and tests have no say), a gazetteer
(issuers, country and area codes, address blocks, domains, names of settings)
and the context (words that speak for or against the kind, or whether the
span stands between words or between numbers; for secrets, quotes). Per kind,
the counts of vote patterns over the whole corpus (at most 27) give each
labeler's reliability and each pattern's probability by
expectation-maximisation. Those soft labels train a naive Bayes classifier on
the span's shape, check digit and surroundings (the word before by a hash
into NAMES values), which doesn't see the votes, again from
counts over all candidates; candidates that it accepts are added to the base
spans. A candidate that overlaps a base span says nothing new, but for a
secret that reaches beyond it.

Only those bounded count tables (vote patterns; feature values) reach the
driver. Positions are code points, end exclusive. The patterns use
possessive repeats and look-behinds, so that runs of any length match in
linear time and constant stack; they find what the plain forms find.

Defined results: null and empty texts have no spans; repeated rows are
handled row by row; an empty table gives no rows; without candidates the
classifier accepts none; further columns are kept (``_p_`` names are
reserved). Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triploom.llm.words import let
from triploom.session import materialize

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
CONTEXT = 32            # characters before a span that the context labeler reads
AFTER = 16              # and behind it
NAMES = 128             # values that the classifier tells apart of the word before
ACCEPT = 0.9            # probability from which a candidate is added
EM_ROUNDS = 40
PULL = 4.0              # spans that a class's share of a feature value is smoothed by

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
HIDDEN_EMAIL = (rf"(?<!{LOCAL}){LOCAL}++\x20?(?:\(at\)|\[at\])\x20?{LABEL}++"
                rf"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?){LABEL}++)++")
LONG_IP = r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])"
SECRET = (r"(?:(?<=[:=]\x20{0,2}[\x22']?)[A-Za-z0-9+/_~-]{16,}+=*+"
          r"|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}"
          r"|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9]))")
LOCAL_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

# Issuer prefixes of payment cards, common country codes,
# common top-level domains, special-purpose address blocks, names of settings
# that hold secrets or don't, and words that speak for or against a kind.
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|6011|65|35)"
COUNTRIES = r"^(?:1|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
DOMAINS = r"(?i)\.(?:com|org|net|edu|gov|io|info|biz|eu|us|uk|de|fr|es|it|nl|ch|at|be|pl|se)$"
FILES = r"(?i)\.(?:png|jpg|jpeg|gif|svg|js|css|py|html|json|txt)$"
NO_HOST = r"^(?:0|127|255|22[4-9]|23[0-9])\."
LONG_BLOCKS = r"(?i)^(?:2|3)[0-9a-f]{3}:|^f[cd][0-9a-f]{2}:|^fe80:"
SECRET_NAMES = (r"(?i)(?:token|secret|passw(?:or)?d|passphrase|credential|api[_-]?key"
                r"|access[_-]?key|private[_-]?key|auth)[A-Za-z0-9_-]{0,16}[\x22']?\x20*"
                r"[:=]\x20*[\x22']?$")
PLAIN_NAMES = (r"(?i)(?:\bid|class|name|href|src|path|url|hash|md5|sha[0-9]*|digest|checksum"
               r"|commit|etag|integrity)[\x22']?\x20*[:=]\x20*[\x22']?$")
KEY_HEADS = r"^(?:AKIA|gh[pousr]_|sk-)"
FOR = {"email": r"(?i)\b(?:e-?mail|contact|write|reach|address)",
       "ip": r"(?i)\b(?:ip|host|server|address|from|login)\b",
       "card": r"(?i)\b(?:card|visa|master|amex|pay|credit|debit)",
       "phone": r"(?i)\b(?:call|phone|tel|mobile|fax|dial)"}
AGAINST = {"email": r"(?i)\b(?:import|package|version)\b",
           "ip": r"(?i)\b(?:version|v|release|section|chapter)\b",
           "card": r"(?i)\b(?:isbn|order|serial|id|tracking|invoice)\b",
           "phone": r"(?i)\b(?:isbn|order|serial|version|total)\b"}


# ------------------------------------------------------------- matches ---

def _matches(text: Column, pattern: str) -> Column:
    """All matches as (start, end, text, before, after): the pieces between
    matches give the positions."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rows = let(pieces, lambda p: F.zip_with(
        F.zip_with(p, found, lambda gap, m: F.struct(gap.alias("gap"), m.alias("m"))),
        F.slice(p, 2, F.size(p)), lambda x, after: F.struct(
            x["gap"].alias("gap"), x["m"].alias("m"), F.substring(after, 1, AFTER).alias("after"))))
    span = lambda s, r: F.struct(
        (s["at"] + F.length(r["gap"])).alias("start"),
        (s["at"] + F.length(r["gap"]) + F.length(r["m"])).alias("end"),
        r["m"].alias("m"), F.right(r["gap"], F.lit(CONTEXT)).alias("before"),
        r["after"].alias("after"))
    kind = "array<struct<start:int,end:int,m:string,before:string,after:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    return F.aggregate(rows, start, lambda s, r: F.when(r["m"].isNull(), s).otherwise(F.struct(
        (s["at"] + F.length(r["gap"]) + F.length(r["m"])).alias("at"),
        F.concat(s["out"], F.array(span(s, r))).alias("out"))), lambda s: s["out"])


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    chars = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(m: Column) -> Column:
    """Whether every part of a dotted number is at most 255."""
    return F.forall(F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "")),
                    lambda p: (F.length(p) <= 3) & (F.coalesce(
                        p.try_cast("int"), F.lit(0)) <= 255))


def _dialled(m: Column) -> Column:
    return F.length(digits_of(m)).between(9, 15)


def _sound(kind: str, m: Column) -> Column:
    """Whether a number keeps its kind's check digit or ranges."""
    if kind == "card":
        return luhn(digits_of(m))
    return m.contains(":") | _octets(m) if kind == "ip" else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(kind: str, m: Column, before: Column, after: Column) -> list[Column]:
    """The three labelers: usual form, gazetteer, context."""
    digits, sound = digits_of(m), _sound(kind, m)
    if kind == "email":
        form = _vote(m.rlike(r"^[A-Za-z0-9](?:.*[^.+_-])?(?:@|\x20?[(\[]at[)\]]\x20?)"
                             r"[A-Za-z0-9].*[A-Za-z]{2,24}$"), m.rlike(r"^[^A-Za-z0-9]|[0-9]$"))
        known = _vote(m.rlike(DOMAINS), m.rlike(FILES))
    elif kind == "ip":
        form = _vote(sound & (m.rlike(r"^(?:(?:0|[1-9][0-9]{0,2})(?:\.|$)){4}$")
                              | (m.contains(":") & m.rlike("[A-Fa-f]"))),
                     ~sound | m.rlike(r"(?:^|\.)0[0-9]"))
        known = _vote(F.when(m.contains(":"), m.rlike(LONG_BLOCKS)).otherwise(
            sound & ~m.rlike(NO_HOST)), F.lit(True))
    elif kind == "card":
        form = _vote(sound & m.rlike(r"^(?:[0-9]{13,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}"
                             r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})$"),
                     ~sound | m.rlike(r"[ -][0-9]{1,2}[ -]|[ -][0-9]{7}"))
        known = _vote(digits.rlike(ISSUERS), ~digits.rlike(ISSUERS))
    elif kind == "phone":
        form = _vote(m.rlike(r"^\+[1-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{2,5}\)?){2,5}$")
                     | m.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}$"),
                     m.rlike(r"^\(?[01]|[ .()-]{3}|[0-9]{12}"))
        known = _vote(F.when(m.startswith("+"), digits.rlike(COUNTRIES)).otherwise(
            digits.rlike("^[2-9][0-9]{2}[2-9]")), F.lit(True))
    else:
        both = m.rlike("[0-9]") & m.rlike("[A-Za-z]")
        # hexadecimal values may be digests as well: no vote
        form = _vote(both & (m.rlike(KEY_HEADS)
                             | m.rlike(r"^(?=[^A-Z]*[A-Z])(?=[^a-z]*[a-z]).{20,}$")),
                     ~both | m.rlike(r"^/|[A-Za-z]{3,}[_/-][A-Za-z]{3,}"))
        known = _vote(before.rlike(SECRET_NAMES) | m.rlike(KEY_HEADS), before.rlike(PLAIN_NAMES))
        return [form, known, _vote(before.rlike(r"[\x22']$") & after.rlike(r"^[\x22']"),
                                   before.rlike("[?&/][^\\s]*$"))]
    numbers = before.rlike(r"[0-9][^\p{L}]*$") | after.rlike(r"^[^\p{L}]*[0-9]")
    words = (before.rlike(r"\p{L}{2}[,;:.]?\s+[\x22'(]?$")
             & after.rlike(r"^[\x22').,;:!?]*(?:\s+\p{L}|\s*$)"))
    cue, odd = before.rlike(FOR[kind]), before.rlike(AGAINST[kind])
    return [form, known, _vote(cue & ~odd | ~odd & ~numbers & words, ~cue & (odd | numbers))]


def _features(kind: str, m: Column, before: Column, after: Column) -> Column:
    """Shape and surroundings, each with a bounded set of values."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        m, "[0-9]+", "9"), "[A-Za-z]+", "a"), "[^9a]", "-")
    side = lambda c: (F.when(F.coalesce(c, F.lit("")) == "", "edge")
                      .when(c.rlike(r"^\s"), "space").when(c.rlike("[A-Za-z]"), "letter")
                      .when(c.rlike("[0-9]"), "digit").otherwise("mark"))
    named = {"shape": F.substring(shape, 1, 8), "prev": side(F.right(before, F.lit(1))),
             "next": side(F.substring(after, 1, 1)),
             "length": F.least(F.length(m), F.lit(40)).cast("string"),
             "digits": F.least(F.length(digits_of(m)), F.lit(40)).cast("string"),
             "sound": F.when(_sound(kind, m), "yes").otherwise("no"),
             "name": F.pmod(F.xxhash64(F.lower(F.regexp_extract(
                 before, r"(\p{L}+)[^\p{L}]*$", 1))), F.lit(NAMES)).cast("string"),
             "word": F.when(before.rlike(r"\p{L}[^\p{L}0-9]{0,4}$"), "letters")
                     .when(before.rlike(r"[0-9][^\p{L}0-9]{0,4}$"), "digits").otherwise("none")}
    return F.array(*[F.concat(F.lit(f"{kind}|{n}="), v) for n, v in named.items()])


def _candidates(text: Column, kind: str, pattern: str, gate: Column, base) -> Column:
    """Matches of one pattern as candidates with votes and features."""
    none = ("array<struct<start:int,kind:int,end:int,base:boolean,"
            "votes:string,features:array<string>>>")
    at = KINDS.index(kind)

    def candidate(x: Column) -> Column:
        is_base = base(x["m"])
        votes = [F.substring(F.lit("-0+"), v + 2, F.lit(1))
                 for v in _votes(kind, x["m"], x["before"], x["after"])]
        return F.struct(
            x["start"].alias("start"), F.lit(at).alias("kind"), x["end"].alias("end"),
            is_base.alias("base"), F.concat(F.lit(f"{kind}|"), *votes).alias("votes"),
            _features(kind, x["m"], x["before"], x["after"]).alias("features"))

    return F.when(gate, F.transform(_matches(text, pattern), candidate).cast(none)).otherwise(
        F.array().cast(none))


def find_candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with _p_found: all candidates of a text, base spans among
    them, by start and kind."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    yes, no = (lambda m: F.lit(True)), (lambda m: F.lit(False))
    dot = text.rlike(r"[0-9]\.[0-9]")
    found = [
        _candidates(text, "email", EMAIL, text.contains("@"), yes),
        _candidates(text, "email", HIDDEN_EMAIL,
                    text.contains("(at)") | text.contains("[at]"), no),
        _candidates(text, "ip", IP, dot, _octets),
        _candidates(text, "ip", LONG_IP, text.rlike("[0-9A-Fa-f]:[0-9A-Fa-f]"), no),
        _candidates(text, "card", CARD, text.rlike("[0-9]"), lambda m: luhn(digits_of(m))),
        _candidates(text, "phone", PHONE, text.contains("+"), _dialled),
        _candidates(text, "phone", LOCAL_PHONE, text.rlike("[0-9]{3}[ .-][0-9]{4}"), no),
        _candidates(text, "secret", SECRET, text.rlike("[A-Za-z0-9+/_~-]{16}"), no),
    ]
    over = lambda b, c: F.when(
        c["kind"] == KINDS.index("secret"), (b["start"] <= c["start"]) & (c["end"] <= b["end"])
    ).otherwise((b["start"] < c["end"]) & (c["start"] < b["end"]))
    free = lambda all_, c: c["base"] | ~F.exists(
        all_, lambda b: b["base"] & over(b, c))
    return docs.withColumn("_p_found", let(F.sort_array(F.concat(*found)), lambda all_: F.filter(
        all_, lambda c: free(all_, c))))


# ---------------------------------------------------------------- model ---

@dataclass(frozen=True)
class SpanModel:
    """Log-odds per feature value and a bias per kind; the labelers'
    reliabilities are kept for reports."""

    weights: dict[str, float]
    bias: dict[str, float]
    reliability: dict[str, list[float]]


def _sign(c: str) -> int:
    return "-0+".index(c) - 1


def estimate_votes(patterns: dict[str, dict[str, int]], rounds: int = EM_ROUNDS):
    """Per kind, from the counts of its vote patterns: each labeler's
    reliability (that a vote it casts is right) and each pattern's
    probability of being personal data."""
    reliability, posterior = {}, {}
    for kind, counts in patterns.items():
        k = len(next(iter(counts)))
        right, prior = [0.8] * k, 0.5
        for _ in range(rounds):
            for votes in counts:
                odds = math.log(prior / (1 - prior))
                for a, c in zip(right, votes):
                    odds += _sign(c) * math.log(a / (1 - a))
                posterior[f"{kind}|{votes}"] = 1 / (1 + math.exp(-odds))
            for j in range(k):
                agree = cast = 0.0
                for votes, n in counts.items():
                    s, p = _sign(votes[j]), posterior[f"{kind}|{votes}"]
                    if s:
                        agree += n * (p if s > 0 else 1 - p)
                        cast += n
                # labelers are taken to be better than chance, and fallible
                right[j] = min(max((agree + 8) / (cast + 10), 0.55), 0.99)
            total = sum(counts.values())
            prior = sum(n * posterior[f"{kind}|{v}"] for v, n in counts.items())
            prior = min(max((prior + 1) / (total + 2), 0.01), 0.99)
        reliability[kind] = right
    return reliability, posterior


def _literal_map(values: dict[str, float]) -> Column:
    pairs = [F.lit(x) for k, v in sorted(values.items()) for x in (k, float(v))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")


def fit(found: DataFrame) -> SpanModel:
    """Train on the stored candidates of all rows (a column _p_found)."""
    spans = found.select(F.explode("_p_found").alias("c"))
    patterns: dict[str, dict[str, int]] = {}
    for r in spans.groupBy(F.col("c.votes").alias("votes")).count().collect():
        kind, votes = r["votes"].split("|")
        patterns.setdefault(kind, {})[votes] = r["count"]
    reliability, posterior = estimate_votes(patterns)
    if not posterior:
        return SpanModel({}, {}, {})
    soft = F.element_at(_literal_map(posterior), F.col("c.votes"))
    counts = (spans.select(soft.alias("p"), F.explode("c.features").alias("f"))
              .groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")))
    totals = {k: (sum(n * posterior[f"{k}|{v}"] for v, n in c.items()),
                  sum(n * (1 - posterior[f"{k}|{v}"]) for v, n in c.items()))
              for k, c in patterns.items()}
    weights = {}
    for r in counts.collect():
        # smoothed towards the value's share in both classes together, so that
        # a class of few spans says little
        yes, no = totals[r["f"].split("|")[0]]
        share = PULL * (r["yes"] + r["no"]) / (yes + no)
        weights[r["f"]] = math.log((r["yes"] + share) / (yes + PULL)) - math.log(
            (r["no"] + share) / (no + PULL))
    bias = {k: math.log((yes + 0.5) / (no + 0.5)) for k, (yes, no) in totals.items()}
    return SpanModel(weights, bias, reliability)


def choose_spans(found: DataFrame, model: SpanModel, accept: float = ACCEPT) -> DataFrame:
    """``found`` with _p_base and _p_spans: arrays of (start, kind, end); the
    latter adds accepted candidates."""
    slim = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"),
                              c["end"].alias("end"))
    out = found.withColumn("_p_base", F.transform(
        F.filter("_p_found", lambda c: c["base"]), slim))
    if not model.weights:
        return out.withColumn("_p_spans", F.col("_p_base"))
    weights, bias = _literal_map(model.weights), _literal_map(model.bias)
    score = lambda c: F.aggregate(
        c["features"], F.element_at(bias, F.substring_index(c["votes"], "|", 1)),
        lambda a, f: a + F.coalesce(F.element_at(weights, f), F.lit(0.0)))
    added = F.filter("_p_found", lambda c: ~c["base"]
                     & (score(c) >= math.log(accept / (1 - accept))))
    return out.withColumn("_p_spans", F.sort_array(F.concat(
        F.col("_p_base"), F.transform(added, slim))))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    name = lambda k: F.get(F.array(*[F.lit(x) for x in KINDS]), k)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_spans(docs: DataFrame, text_col: str = "text",
               carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (all by default) of every row with _p_base and
    _p_spans."""
    carry = list(docs.columns) if carry is None else carry
    found = materialize(find_candidates(docs, text_col).select(*carry, "_p_found"), "pii")
    return choose_spans(found, fit(found)).drop("_p_found")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; of
    overlapping spans the first (by start, then kind) is replaced and the
    rest of a later one goes with it."""
    # the candidates are found twice, for the model and for the spans, so
    # that no text is stored
    candidates = find_candidates(docs, text_col)
    model = fit(materialize(candidates.select("_p_found"), "pii"))
    found = choose_spans(candidates, model)
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    name = lambda k: F.get(F.array(*[F.lit(f"<{x.upper()}>") for x in KINDS]), k)
    cut = lambda a, b: F.substring(text, a + 1, F.greatest(b - a, F.lit(0)))
    clean = F.aggregate("_p_spans", start, lambda s, x: F.struct(
        F.greatest(s["at"], x["end"]).alias("at"),
        F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(
            cut(s["at"], x["start"]), name(x["kind"])))).otherwise(s["out"]).alias("out")),
        lambda s: F.concat(F.array_join(s["out"], ""), cut(s["at"], F.length(text))))
    return found.withColumn(text_col, F.when(F.size("_p_spans") > 0, clean).otherwise(text)) \
        .select(*docs.columns)
