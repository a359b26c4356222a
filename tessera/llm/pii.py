"""Personal data by weak supervision, in DataFrame functions only.

Candidates are the matches of four fixed patterns (email, ip, card, phone), valid or not, and
of looser ones (addresses with '[at]', IPv6, telephone numbers without '+').  Five labelers
vote for (1), against (-1) or abstain (0) on each: the strict pattern, a checksum or range,
a gazetteer, words in front, and the neighbouring characters.  The votes of all candidates of
all texts are counted by pattern; expectation-maximisation over these counts (at most a few
hundred rows) estimates how reliable each labeler is for each kind and how likely each pattern
of votes is personal data.  With these as soft labels a logistic span classifier is trained.

Spans that the fixed rules accept always stay, and matches of the fixed patterns that they
reject are only learned from; a candidate of a looser pattern is added if the classifier gives
it at least ``ACCEPT`` and it overlaps no accepted span of its kind.  Offsets are code
points, ends exclusive.  They come from the lengths of matches and of the text between them
(``split`` and ``regexp_extract_all`` with one pattern), summed in blocks so that a text with
very many matches takes linear time.  Patterns are written with possessive quantifiers and
look-behinds, which match the same spans without deep recursion or repeated scanning.

Null text counts as empty and has no span.  Repeated rows give repeated rows; an empty table
gives an empty table and trains nothing.  Only the id and text are read by ``detect``;
``redact`` keeps all columns, and null text stays null.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh

KINDS = ("email", "ip", "card", "phone")
BLOCK = 512
CONTEXT = 24
ACCEPT = 0.9
ROUNDS = 25
LABELERS = 5

_LOCAL = "[A-Za-z0-9._%+-]"
_NAME = "[A-Za-z0-9-]"
#: Kind -> patterns; the first one of a kind is the fixed one.
PATTERNS = {
    "email": (rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
              rf"(?<!{_LOCAL}){_LOCAL}++ ?[\[({{][Aa][Tt][\])}}] ?{_NAME}++(?: ?(?:\.|[\[({{][Dd][Oo][Tt][\])}}]) ?{_NAME}++)++"),
    "ip": (r"(?=[0-9])(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
           r"(?=[0-9A-Fa-f])(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++",),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]",
              r"(?=[(0-9])(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])"),
}
#: A cheap condition that every text with a match (ip, card: a valid one) meets.
_DIGITS = r"[0-9][0-9.\x20-]{5,}[0-9]"
WORTHWHILE = {
    "email": (lambda t: t.contains("@"), lambda t: t.rlike(r"(?i)[\[({]at[\])}]")),
    "ip": (lambda t: t.rlike(_DIGITS), lambda t: t.contains(":")),
    "card": (lambda t: t.rlike(_DIGITS),),
    "phone": (lambda t: t.contains("+"), lambda t: t.rlike(_DIGITS)),
}
# Gazetteers and context words.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "it", "uk", "nl", "eu", "us")
CALLING_CODES = r"^\+(1|7|20|27|3[0-469]|4[0134-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CARD_ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6)"
NOT_PERSONAL_IP = r"^(0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
WORDS_FOR = {"email": "mail|contact|write to", "ip": r"\bip\b|addr|host|login|client", "card": "card|visa|master|amex|credit|payment",
             "phone": "phone|tel|call|mobile|cell|fax|whatsapp"}
WORDS_AGAINST = r"version|\bv$|invoice|order|isbn|serial|\bid\b|\bno\.? *$|\$ *$|sha|token"


def _matches(text: Column, kind: str, i: int) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind][i]), F.lit(0))
    return F.when(WORTHWHILE[kind][i](text), found).otherwise(F.array().cast("array<string>"))


def _around(found: Column, gaps: Column) -> Column:
    """Per match: the text between it and the last match, the end of that, the next character."""
    n = F.size(found)
    return F.zip_with(F.slice(gaps, F.lit(1), n), F.slice(gaps, F.lit(2), n), lambda b, a: F.struct(
        b.alias("gap"), F.substring(b, -CONTEXT, CONTEXT).alias("before"), F.substring(a, 1, 1).alias("after")))


def _sizes(found: Column, gaps: Column) -> Column:
    """Per match: the length of the text before it and its own."""
    return F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                      lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("own")))


def _places(sizes: Column, blocks: Column) -> Column:
    """Per match: start and end, from its sizes, also given in blocks.

    Sums run inside blocks, then over blocks, as growing an array copies it.  Lambdas use
    their own element only: a column named in a lambda may be computed again for each.
    """
    none = F.array().cast("array<int>")

    def running(items, start, step):
        state = F.struct(start.cast("int").alias("sum"), none.alias("out"))
        return F.aggregate(items, state, lambda a, x: F.struct(
            (a["sum"] + step(x)).cast("int").alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out")))["out"]

    def both(x):
        return x["gap"] + x["own"]

    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + both(x)))
    starts = F.flatten(F.zip_with(blocks, running(sums, F.lit(0), lambda x: x), lambda b, s: running(b, s, both)))
    return F.zip_with(starts, sizes, lambda s, x: F.struct((s + x["gap"]).alias("start"), (s + both(x)).alias("end")))


def _luhn(digits: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + _luhn_term(
        F.substring(F.reverse(digits), i, F.lit(1)).cast("int"), i)) % 10 == 0


def _luhn_term(d: Column, i: Column) -> Column:
    return F.when(i % 2 == 1, d).when(d > 4, d * 2 - 9).otherwise(d * 2)


def _valid(kind: str, value: Column) -> Column:
    """The fixed rules on a match of the fixed pattern."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), _luhn(digits)).otherwise(F.lit(False))
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _vote(yes, no=None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _votes(kind: str, strict: bool, s: Column) -> list[Column]:
    """The five labelers' votes on a candidate (start, end, value, before, after)."""
    value, valid = s["value"], _valid(kind, s["value"]) if strict else F.lit(False)
    words = F.lower(s["before"])
    n = F.length(F.regexp_replace(value, "[^0-9]", ""))
    if kind == "email":
        check = _vote(F.length(value) <= 254, F.length(value) > 254)
        known = _vote(F.lower(F.substring_index(value, ".", -1)).isin(*TOP_LEVEL))
    elif kind == "ip":
        check = _vote(valid, F.lit(strict) & ~valid)
        known = _vote(F.lit(not strict), value.rlike(NOT_PERSONAL_IP))
    elif kind == "card":
        check = _vote(valid, ~valid)
        known = _vote(value.rlike(CARD_ISSUERS) & n.between(13, 19), ~n.between(13, 19))
    else:
        check = _vote(n.between(9, 15), ~n.between(9, 15))
        known = _vote(value.rlike(CALLING_CODES))
    glued = F.regexp_extract(s["before"], ".$", 0).rlike("[0-9A-Za-z]") | s["after"].rlike("[0-9A-Za-z]")
    return [F.lit(1 if strict else 0), check, known, _vote(words.rlike(WORDS_FOR[kind]), words.rlike(WORDS_AGAINST)),
            _vote(~glued, glued)]


def _in_blocks(column: str) -> Column:
    """An array in blocks of BLOCK elements.  The one lambda that names a column: it runs once a
    block, over a column that the projection below has computed."""
    blocks = F.floor((F.size(column) - 1) / BLOCK).cast("int")
    return F.when(F.size(column) > 0, F.transform(F.sequence(F.lit(0), blocks), lambda b: F.slice(F.col(column), b * BLOCK + 1, BLOCK)))


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(doc_id, spans): all candidates with kind number, offsets, ``base`` and their votes."""
    text = fresh(docs, "plain_text")
    out = docs.select("doc_id", F.coalesce(F.col(text_col), F.lit("")).alias(text))
    names = [(kind, i, f"_{kind}{i}") for kind in KINDS for i in range(len(PATTERNS[kind]))]
    # Columns of their own: a pattern runs over a text once, and again to split texts that match.
    out = out.withColumns({n: _matches(F.col(text), k, i) for k, i, n in names})
    out = out.withColumns({f"{n}_gaps": F.when(F.size(n) > 0, F.split(text, PATTERNS[k][i], -1)) for k, i, n in names})
    out = out.withColumns({f"{n}_sizes": _sizes(F.col(n), F.col(f"{n}_gaps")) for k, i, n in names})
    out = out.withColumns({f"{n}_blocks": _in_blocks(f"{n}_sizes") for k, i, n in names})

    def spans(n):
        places = _places(F.col(f"{n}_sizes"), F.col(f"{n}_blocks"))
        valued = F.zip_with(places, F.col(n), lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), v.alias("value")))
        return F.zip_with(valued, _around(F.col(n), F.col(f"{n}_gaps")), lambda x, y: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), y["before"].alias("before"), y["after"].alias("after")))

    out = out.withColumns({n: F.when(F.size(n) > 0, spans(n)) for k, i, n in names})

    def judged(kind, strict):
        def one(s):
            base = _valid(kind, s["value"]) if strict else F.lit(False)
            votes = F.array(*_votes(kind, strict, s))
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                            base.alias("base"), votes.alias("votes"))
        return one

    empty = F.array().cast("array<struct<kind:int,start:int,end:int,base:boolean,votes:array<int>>>")
    judged_arrays = [F.coalesce(F.transform(F.col(n), judged(k, i == 0)), empty) for k, i, n in names]
    return out.select("doc_id", F.concat(*judged_arrays).alias("spans"))


def estimate(patterns: list[tuple[int, tuple, int]]) -> dict[tuple, float]:
    """Posterior of each (kind, votes) pattern with its count, by expectation-maximisation over
    labeler reliabilities per kind; abstentions say nothing."""
    post = {(k, v): 1 / (1 + math.exp(-sum(v))) for k, v, _ in patterns}
    for _ in range(ROUNDS):
        right, share = {}, {}
        for k, v, n in patterns:
            p = post[k, v]
            s = share.setdefault(k, [1.0, 1.0])
            s[1] += n * p
            s[0] += n * (1 - p)
            for j, vote in enumerate(v):
                if vote:  # [votes that are right, votes], starting from better than chance
                    for y, mass in ((1, n * p), (0, n * (1 - p))):
                        r = right.setdefault((k, j, y), [2.0, 3.0])
                        r[0] += mass * (vote == (1 if y else -1))
                        r[1] += mass
        for k, v, _ in patterns:
            odds = math.log(share[k][1] / share[k][0])
            for j, vote in enumerate(v):
                if vote:
                    yes, no = (right[k, j, y][0] / right[k, j, y][1] for y in (1, 0))
                    odds += math.log(yes / (1 - no)) if vote > 0 else math.log((1 - yes) / no)
            post[k, v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def _features(kind: Column, votes: Column) -> list[Column]:
    out = [(kind == k) for k in range(len(KINDS))]
    for k in range(len(KINDS)):
        for j in range(LABELERS):
            out += [(kind == k) & (F.get(votes, F.lit(j)) == s) for s in (1, -1)]
    return [c.cast("double") for c in out]


def fit(found: DataFrame) -> list[float] | None:
    """Weights of the span classifier (intercept last) from all candidates of ``found``."""
    counts = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes").agg(F.count(F.lit(1)).alias("n"))
    # At most kinds x 3^5 rows, whatever the input.
    patterns = [(r["kind"], tuple(r["votes"]), r["n"]) for r in counts.collect()]
    if not patterns:
        return None
    post = estimate(patterns)
    rows = ", ".join(f"({k}, array({', '.join(map(str, v))}), {float(n)}D, {post[k, v]!r}D)" for k, v, n in patterns)
    table = counts.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(kind, votes, n, p)")
    names = [f"f{i}" for i in range(len(KINDS) * (1 + 2 * LABELERS))]
    table = table.select(F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
                                           F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("y"),
                         *[c.alias(n) for n, c in zip(names, _features(F.col("kind"), F.col("votes")))])
    table = VectorAssembler(inputCols=names, outputCol="features").transform(table.select("y.*", *names))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=30).fit(table)
    return [*model.coefficients.toArray().tolist(), model.intercept]


def _chance(weights: list[float], kind: Column, votes: Column) -> Column:
    """The classifier's probability; each labeler's weight is looked up by its vote."""
    own = F.get(F.array(*(F.lit(w) for w in weights[:len(KINDS)])), kind)
    by_vote = [F.array(*(F.struct(F.lit(weights[at]).alias("yes"), F.lit(weights[at + 1]).alias("no")) for at in
                         range(len(KINDS) + 2 * LABELERS * k, len(KINDS) + 2 * LABELERS * (k + 1), 2))) for k in range(len(KINDS))]
    terms = F.zip_with(votes, F.get(F.array(*by_vote), kind), lambda v, w: F.when(v > 0, w["yes"]).when(v < 0, w["no"]).otherwise(0.0))
    return 1 / (1 + F.exp(-F.aggregate(terms, own + F.lit(weights[-1]), lambda a, x: a + x)))


def _accepted(spans: Column, weights: list[float] | None) -> Column:
    """Base spans and the added ones, by kind, start and end."""
    base = F.filter(spans, lambda s: s["base"])
    if weights is None:
        return base
    # The first vote tells loose candidates; what the fixed rules reject is only learned from.
    added = F.filter(spans, lambda s: (F.get(s["votes"], F.lit(0)) == 0) & (_chance(weights, s["kind"], s["votes"]) >= ACCEPT) & ~F.exists(
        base, lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.concat(base, added)


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per document: doc_id, the number of base spans of each kind, a digest of them, all spans."""
    found = cut(candidates(docs, text_col))
    weights = fit(found)
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                        _listed(_accepted(F.col("spans"), weights)).alias("spans"))


def _united(docs: DataFrame, text_col: str, weights: list[float] | None) -> DataFrame:
    """``docs`` where, in texts in which accepted spans overlap, each union of overlapping spans
    is replaced by the kind of its first (then longest) span."""
    rows = docs.select(F.struct(*docs.columns).alias("doc_id"), F.col(text_col).alias("text"))
    found = candidates(rows)
    ordered = F.array_sort(F.transform(_accepted(F.col("spans"), weights), lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("longest"), s["kind"].alias("kind"))))
    row, spans = fresh(docs, "whole_row"), fresh(docs, "ordered_spans")
    found = found.select(F.col("doc_id").alias(row), ordered.alias(spans))
    n = F.size(spans)
    overlaps = F.exists(F.zip_with(F.slice(spans, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(spans, F.lit(2), n),
                                   lambda x, y: -x["longest"] > y["start"]), lambda x: x)
    text = F.col(row)[text_col]
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    union = F.aggregate(spans, state, lambda a, s: F.struct(
        F.greatest(a["at"], -s["longest"]).alias("at"),
        F.when(s["start"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.get(names, s["kind"])))
        .otherwise(a["out"]).alias("out")), lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    changed = F.when((n > 1) & overlaps, union).otherwise(text)
    return found.select(*(changed.alias(c) if c == text_col else F.col(row)[c].alias(c) for c in docs.columns))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, such as ``[EMAIL]``.

    Spans that overlap are replaced as one, found in the original text.  Then kinds are replaced
    one after another, which also finds what stands alone only after a neighbour is gone.  A
    text with overlaps takes time by its length for each of its spans, others linear time.
    """
    weights = fit(cut(candidates(docs, text_col).where(F.size("spans") > 0)))
    out, found, gaps = _united(docs, text_col, weights), fresh(docs, "found_spans"), fresh(docs, "gaps_between")
    for kind in KINDS:
        for i, pattern in enumerate(PATTERNS[kind]):
            strict, text = i == 0, F.coalesce(F.col(text_col), F.lit(""))
            if not strict and weights is None:
                continue

            def replaced(s, kind=kind, strict=strict):
                keep = _valid(kind, s["value"]) if strict else _chance(
                    weights, F.lit(KINDS.index(kind)), F.array(*_votes(kind, strict, s))) >= ACCEPT
                return F.when(keep, f"[{kind.upper()}]").otherwise(s["value"])

            out = out.withColumn(found, _matches(text, kind, i))
            out = out.withColumn(gaps, F.when(F.size(found) > 0, F.split(text, pattern, -1)))
            pieces = F.zip_with(_around(F.col(found), F.col(gaps)), F.col(found), lambda x, v: F.concat(x["gap"], replaced(
                F.struct(v.alias("value"), x["before"].alias("before"), x["after"].alias("after")))))
            joined = F.concat(F.array_join(pieces, ""), F.element_at(gaps, -1))
            out = out.withColumn(text_col, F.when(F.size(found) > 0, joined).otherwise(F.col(text_col))).drop(found, gaps)
    return out
