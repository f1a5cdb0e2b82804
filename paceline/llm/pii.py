"""Operator 10: personal data by weak supervision, in DataFrame functions only.

Candidates are spans of four kinds: the *base* matches of strict patterns
(always personal data) and *loose* matches that those miss, such as an address
written with "at" and "dot", a telephone number without a country code, a card
number with an unusual grouping or an IPv6 address.  Four labelers look at
every candidate and vote for (1), against (-1) or abstain (0):

* regex: does it fit the strict form once its separators are normalised;
* gazetteer: known top-level domains, area codes, card issuers, address blocks;
* context: a cue word of the kind shortly before it;
* surroundings: does it stand alone, or inside a longer token or a number list.

Expectation-maximisation over the counts of vote patterns estimates, without
labels, how often each labeler votes for either class, by kind.  The resulting
posteriors train the span classifier, a logistic regression on the votes, the
kind and the length; it decides on the loose candidates.  Only the table of
vote patterns (at most 4 kinds x 3^4 votes x 4 lengths rows, counted in Spark)
reaches the driver.

A loose span that overlaps a base span is no candidate.  Null and empty texts
have no spans; texts are searched whole.  Patterns are written so that no
start is tried twice inside a run, which keeps very long texts linear.
Positions count code points, end exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.common import let

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("regex", "gazetteer", "context", "alone")
THRESHOLD = 0.5
CONTEXT_CHARS = 40
# A run is entered at its start only, or where the match before it ended.
# Possessive loops give nothing back, so a match of any length needs no stack.
_LOCAL, _DIGITS = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++", r"(?:(?<![0-9])|\G)[0-9]++"
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _DIGITS + r"(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without this need no search.
HINT = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_AT, _DOT = r"(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)", r"(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)"
LOOSE = {
    "email": _LOCAL + _AT + rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
}
# A hint is a part of its pattern, so every match holds it.
LOOSE_HINT = {"email": rf"{_AT}[A-Za-z0-9-]++{_DOT}[A-Za-z0-9-]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]",
              "card": r"[0-9]{4}[._/][0-9]{4}", "phone": r"[0-9]{3}[.\x20-][0-9]{4}"}
# Public top-level domains, and words that announce personal data.
DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "io", "co", "info", "biz", "me", "de", "fr", "es", "it",
           "uk", "us", "eu", "ch", "at", "nl", "be", "se", "no", "dk", "fi", "pl", "pt", "ru", "cn", "jp", "in", "br",
           "ca", "au")
CUES = {
    "email": "mail|contact|write|reach|courriel|correo|schreib",
    "ip": "ip|address|host|server|client|login|adresse",
    "card": "card|visa|credit|debit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|fax|mobile|cell|dial|whatsapp|anruf|appel|llam",
}


def _found(text: Column, pattern: str, hint: str) -> Column:
    """All leftmost matches: array of (s, e, t)."""
    kind = "array<struct<s:int,e:int,t:string>>"
    none = F.array().cast(kind)

    def walk(found: Column) -> Column:
        def step(state: Column, i: Column, gaps: Column) -> Column:
            start = state["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            span = F.struct(start.alias("s"), end.alias("e"), F.get(found, i).alias("t"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))
        # what lies between the matches gives their places
        return let(F.split(text, pattern, -1), lambda gaps: F.aggregate(
            F.sequence(F.lit(0), F.size(found) - 1), F.struct(F.lit(0).alias("at"), none.alias("out")),
            lambda state, i: step(state, i, gaps), lambda state: state["out"]))
    return F.when(text.rlike(hint), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                                        lambda m: F.when(F.size(m) > 0, walk(m)).otherwise(none))).otherwise(none)


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn checksum of a string of digits holds."""
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _holds(kind: str, t: Column) -> Column:
    if kind == "ip":
        return t.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return let(_digits(t), lambda d: F.length(d).between(16, 19) & F.when(
            F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(t)).between(8, 15)
    return F.lit(True)


def _votes(kind: str, text: Column, s: Column, e: Column, t: Column) -> list[Column]:
    """What the four labelers say about text[s:e] = t."""
    before = F.lower(F.substring(text, F.greatest(s - CONTEXT_CHARS, F.lit(0)) + 1, F.least(s, F.lit(CONTEXT_CHARS))))
    last = F.substring(text, s, F.when(s > 0, 1).otherwise(0))
    after = F.substring(text, e + 1, F.lit(2))
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(t, r"\x20?[\[(]?\bat\b[\])]?\x20?", "@"),
                                 r"\x20?[\[(]?\bdot\b[\])]?\x20?", ".")
        form = plain.rlike(r"^[^@]{2,}@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}$") & ~plain.rlike(r"@.*\.\.")
        known = F.lower(F.regexp_extract(plain, r"\.([A-Za-z0-9-]+)$", 1)).isin(*DOMAINS)
    elif kind == "ip":
        form = t.rlike(r"^[0-9.]+$|^[0-9A-Fa-f:]+$")
        known = ~t.rlike(r"^(?:0|22[4-9]|2[3-5][0-9])\.")
    elif kind == "card":
        form = luhn(_digits(t))
        known = _digits(t).rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)")
    else:
        form = F.length(_digits(t)).between(10, 15)
        known = t.rlike(r"^\+|^\(?[2-9][0-9]{2}")
    alone = ~last.rlike(r"[\p{L}\p{N}._=\"'/-]") & ~after.rlike(r"^(?:[\p{L}\p{N}_=\"'/]|[.-][\p{L}\p{N}])")
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    return [F.when(form, yes).otherwise(no), F.when(known, yes).otherwise(no),
            F.when(before.rlike(CUES[kind]), yes).otherwise(none), F.when(alone, yes).otherwise(no)]


def candidates(text: Column) -> Column:
    """array of (kind, s, e, base, votes, long): base spans first, by kind and place."""
    text = F.coalesce(text, F.lit(""))

    def rows(kind: str, spans: Column, base: bool) -> Column:
        return F.transform(spans, lambda x: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.lit(base).alias("base"),
            F.array(*_votes(kind, text, x["s"], x["e"], x["t"])).alias("votes"),
            F.least(F.floor((x["e"] - x["s"]) / 10), F.lit(3)).cast("int").alias("long")))

    def true_ones(kind: str) -> Column:
        return F.filter(_found(text, BASE[kind], HINT[kind]), lambda x: _holds(kind, x["t"]))

    strict = F.concat(*[rows(k, true_ones(k), True) for k in KINDS])
    loose = F.concat(*[rows(k, _found(text, LOOSE[k], LOOSE_HINT[k]), False) for k in KINDS])
    return let(strict, lambda b: F.concat(b, F.filter(loose, lambda x: ~F.exists(
        b, lambda y: (y["s"] < x["e"]) & (x["s"] < y["e"])))))


@dataclass
class SpanModel:
    """Logistic regression on kind, votes and length."""

    bias: float
    weights: dict[tuple, float]      # ("kind", k), ("vote", labeler, v), ("long", n)
    reliability: dict[tuple, float]  # (kind, labeler, class, vote) -> probability, as EM estimated it

    def accepts(self, x: Column) -> Column:
        score = F.lit(self.bias)
        for (what, *of), w in sorted(self.weights.items(), key=str):
            value = {"kind": lambda of=of: x["kind"] == of[0], "long": lambda of=of: x["long"] == of[0],
                     "vote": lambda of=of: F.get(x["votes"], of[0]) == of[1]}[what]()
            score = score + F.when(value, F.lit(w)).otherwise(F.lit(0.0))
        return score >= math.log(THRESHOLD / (1 - THRESHOLD))


def patterns(docs: DataFrame) -> list[tuple[int, bool, tuple, int, int]]:
    """(kind, base, votes, long, count): the bounded table of vote patterns."""
    spans = docs.select(F.explode(candidates(F.col("text"))).alias("x")).select("x.*")
    counted = spans.groupBy("kind", "base", "votes", "long").agg(F.count(F.lit(1)).alias("n"))
    return sorted((r.kind, r.base, tuple(r.votes), r.long, r.n) for r in counted.collect())


def estimate(table: list[tuple], rounds: int = 50) -> tuple[list[float], dict[tuple, float]]:
    """EM for two classes with independent labelers given kind and class.
    Returns the posterior of every pattern and the labelers' reliabilities."""
    # start from the share of votes for; strict matches are taken as true throughout
    post = [1.0 if base else (0.5 + sum(votes) / (2 * len(votes) + 1)) for _, base, votes, _, _ in table]
    rates: dict[tuple, float] = {}
    for _ in range(rounds):
        prior: dict[tuple, float] = {}
        rates = {}
        for (kind, _, votes, _, n), p in zip(table, post):
            for cls, share in ((1, p), (0, 1 - p)):
                prior[kind, cls] = prior.get((kind, cls), 1.0) + share * n
                for j, v in enumerate(votes):
                    rates[kind, j, cls, v] = rates.get((kind, j, cls, v), 0.0) + share * n

        def rate(kind: int, j: int, cls: int, v: int) -> float:
            # a labeler is thought right twice as often as wrong before any row is seen
            seen = sum(rates.get((kind, j, cls, u), 0.0) for u in (-1, 0, 1))
            lean = 2.0 if v == (1 if cls else -1) else 1.0
            return (rates.get((kind, j, cls, v), 0.0) + lean) / (seen + 4.0)

        after = []
        for (kind, base, votes, _, _) in table:
            odds = math.log(prior[kind, 1]) - math.log(prior[kind, 0])
            for j, v in enumerate(votes):
                odds += math.log(rate(kind, j, 1, v)) - math.log(rate(kind, j, 0, v))
            after.append(1.0 if base else 1 / (1 + math.exp(-max(-50.0, min(50.0, odds)))))
        moved = max((abs(a - b) for a, b in zip(post, after)), default=0.0)
        post = after
        rates = {(k, j, c, v): rate(k, j, c, v) for k in range(len(KINDS)) for j in range(len(LABELERS))
                 for c in (0, 1) for v in (-1, 0, 1)}
        if moved < 1e-6:
            break
    return post, rates


def train(docs: DataFrame, steps: int = 400, penalty: float = 1e-3) -> SpanModel:
    """EM, then the classifier on its posteriors.  Base spans teach the votes
    of true spans; patterns without any vote for never count as true."""
    table = patterns(docs)
    post, reliability = estimate(table)
    total = sum(n for *_, n in table) or 1
    rows = []
    for (kind, _, votes, long, n), p in zip(table, post):
        names = [("kind", kind), ("long", long), *(("vote", j, v) for j, v in enumerate(votes) if v)]
        rows.append((names, p, n / total))
    weights = {f: 0.0 for names, _, _ in rows for f in names}
    bias = 0.0
    # before any data: a vote for speaks for, a vote against speaks against
    centre = {f: float(f[2]) if f[0] == "vote" else 0.0 for f in weights}
    weights, bias = dict(centre), -1.0
    for step in range(steps):
        rate = 4.0 / (1 + step / 100)
        grad, g0 = {f: -penalty * (w - centre[f]) for f, w in weights.items()}, -penalty * (bias + 1.0)
        for names, p, share in rows:
            score = bias + sum(weights[f] for f in names)
            error = share * (p - 1 / (1 + math.exp(-max(-50.0, min(50.0, score)))))
            g0 += error
            for f in names:
                grad[f] += error
        bias += rate * g0
        for f in weights:
            weights[f] += rate * grad[f]
    return SpanModel(bias, weights, reliability)


def find_spans(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, s, e, base), by kind and place."""
    taken = F.filter(candidates(F.col("text")), lambda x: x["base"] | model.accepts(x))
    plain = F.array_sort(F.transform(taken, lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["base"].alias("base"))))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns], plain.alias("__spans"))


def show(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    names = F.lit(list(KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame, model: SpanModel) -> DataFrame:
    """(doc_id, base counts by kind, base_sha256, spans)."""
    spans = F.col("__spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == kind))).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    base = F.filter(spans, lambda x: x["base"])
    return find_spans(docs.select("doc_id", "text"), model).select(
        "doc_id", *counts, F.sha2(show(base).cast("binary"), 256).alias("base_sha256"), show(spans).alias("spans"))


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.
    Overlapping spans become one, named after the first."""
    def rewrite(spans: Column) -> Column:
        text = F.col("text")
        by_place = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
        names = F.lit([f"<{k.upper()}>" for k in KINDS])

        def step(state: Column, x: Column) -> Column:
            gap = F.substring(text, state["at"] + 1, F.greatest(x["s"] - state["at"], F.lit(0)))
            name = F.when(x["s"] >= state["at"], F.get(names, x["kind"])).otherwise(F.lit(""))
            return F.struct(F.greatest(x["e"], state["at"]).alias("at"), F.concat(state["out"], gap, name).alias("out"))
        return F.aggregate(by_place, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                           lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    found = find_spans(docs, model)
    text = F.when(F.size("__spans") > 0, let(F.col("__spans"), lambda s: rewrite(s))).otherwise(F.col("text"))
    return found.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
