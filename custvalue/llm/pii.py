"""Personal data by weak supervision, in DataFrame functions only.

Regular expressions propose candidate spans: the base patterns of four kinds,
and looser shapes that the base patterns miss: a phone or card number whose greedy
match ran into the next number, a dotted quad inside a longer run or with
written-out dots, a spelled-out e-mail address.  Labelling functions
(base rule, form, gazetteer, context, embedding, shape) vote for or against each
candidate or abstain.  Expectation-maximisation over the counts of vote patterns
in all documents estimates how reliable each function is for each kind, without
labels; the resulting probabilities train a logistic classifier on the votes and
on traits of the span itself (length, digits, separators, neighbouring
characters), which decides about the candidates beyond the base spans.  Base
spans always stay.  Context is what stands up to 24 code points before a
candidate and 4 after it.

Spark does all work on texts and spans.  Only the table of vote and trait
patterns comes to the driver: at most 4 kinds, 3^6 votes and 4 x 5 x 5 x 4 x 4
traits at any input size; a few hundred of them occur.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import written

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.9
TRUST = 20.0       # prior successes of a labelling function per failure

# The base patterns.  Possessive quantifiers keep them linear and free of
# recursion on long runs and match the same spans: what follows each run cannot
# be part of it.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Shapes beyond the base patterns, as lookaheads: they may overlap, and all are proposed.
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_DOT = r"(?:\.|\[\.\]|\(\.\)| ?[(\[]dot[)\]] ?)"
MORE = {
    "email": r"(?<![A-Za-z0-9._%+-])(?=([A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]++)++))",
    "ip": rf"(?<![0-9])(?=({_OCTET}{_DOT}{_OCTET}{_DOT}{_OCTET}{_DOT}{_OCTET})(?![0-9]))",
    "card": r"(?<![0-9])(?=([0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{14,19})(?![0-9]))",
    "phone": r"(?<![0-9+])(?=(\+1[ .-][0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|(?:\+[0-9]{1,3} ?)?\([0-9]{2,4}\) ?[0-9]{3}[ .-][0-9]{4}"
             r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){3,4})(?![0-9]))",
}
# What a text must contain for a pattern to match at all.
GATE = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    "more email": lambda t: t.rlike(r"[(\[]at[)\]]"),
    "more ip": lambda t: t.rlike(r"[0-9](?:\.|\[\.\]|\(\.\)| ?[(\[]dot[)\]] ?)[0-9]"),
    "more card": lambda t: t.rlike(r"[0-9]{4}[\x20-]?[0-9]{4}"),
    "more phone": lambda t: t.rlike(r"\([0-9]{2,4}\)|\+[0-9]"),
}
# Gazetteers and context words.
DOMAINS = "com|org|net|edu|gov|io|info|biz|de|fr|es|uk|it|nl|eu|us|ca|ch|at|be|pl|pt|se|no|dk|ru|cn|jp|in|br|mx|au"
CALLING_CODES = "1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|54|55|56|57|60|61|62|63|64|65|66|81|82|84|86|90|91|92|351|352|353|358|420|971|972"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|38|62|50|56|57|58"
FOR_WORDS = {
    "email": r"(?i)(e-?mail|contact|write to|correo|courriel)[^A-Za-z]*$",
    "ip": r"(?i)(\bip\b|address|host|server|from)[^A-Za-z]*$",
    "card": r"(?i)(card|visa|mastercard|credit|karte|carte|tarjeta)[^A-Za-z]*$",
    "phone": r"(?i)(phone|call|tel|mobile|fax|telefon|t.l.fono|appel)[^A-Za-z]*$",
}
AGAINST_WORDS = r"(?i)(version|release|token|license|licence|isbn|order|page|id|key|hash)\W*$"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    ones = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)))
    return F.aggregate(F.filter(ones, lambda x: x.isNotNull()), F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.when(n.between(14, 19), luhn(_digits(hit))).otherwise(F.lit(False))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _found(text: Column, pattern: str, gate: Column) -> Column:
    """array<struct<gap, before, hit, after>>: every match with the length of the gap before it and some context."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.zip_with(gaps, F.slice(gaps, F.lit(2), F.size(gaps)), lambda g, after: F.struct(
        F.length(g).alias("gap"), F.right(g, F.lit(24)).alias("before"), F.left(after, F.lit(4)).alias("after"))), hits,
        lambda p, h: F.struct(p["gap"].alias("gap"), p["before"].alias("before"), h.alias("hit"), p["after"].alias("after")))
    return F.when(gate, F.filter(parts, lambda p: p["hit"].isNotNull()))


def _found_ahead(text: Column, pattern: str, gate: Column) -> Column:
    """As ``_found`` for a lookahead whose group 1 is the hit; ``gap`` reaches from one hit's start to the next's.

    A blank stands before the text, for a split at its very start would be left out.
    """
    text = F.concat(F.lit(" "), text)
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    parts = F.zip_with(F.zip_with(gaps, F.slice(gaps, F.lit(2), F.size(gaps)), lambda g, rest: F.struct(g.alias("gap"), rest.alias("rest"))), hits,
                       lambda p, h: F.struct(F.length(p["gap"]).alias("gap"), F.right(p["gap"], F.lit(24)).alias("before"), h.alias("hit"),
                                             F.substring(p["rest"], F.length(h) + 1, F.lit(4)).alias("after")))
    return F.when(gate, F.filter(parts, lambda p: p["hit"].isNotNull()))


def _traits(hit: Column, before: Column, after: Column) -> Column:
    """Five small codes of the span itself: length, digits, separators, the characters around it."""
    n, digits = F.length(hit), F.length(_digits(hit))
    seps = F.regexp_replace(hit, r"[\p{L}0-9+@_%]", "")
    near = lambda c: (F.when(c == "", "e").when(c.rlike(r"^[\p{L}_]$"), "l").when(c.rlike("^[0-9]$"), "d").otherwise("o"))
    return F.concat(F.when(n < 10, "0").when(n < 16, "1").when(n < 24, "2").otherwise("3"),
                    F.when(digits < 4, "0").when(digits < 10, "1").when(digits < 14, "2").when(digits < 17, "3").otherwise("4"),
                    F.when(seps == "", "n").when(seps.rlike("^ +$"), "s").when(seps.rlike("^-+$"), "d").when(seps.rlike(r"^\.+$"), "p").otherwise("m"),
                    near(F.right(before, F.lit(1))), near(F.left(after, F.lit(1))))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(F.coalesce(yes, F.lit(False)), F.lit("+")).when(F.coalesce(no, F.lit(False)), F.lit("-")).otherwise(F.lit("0"))


def _by_kind(value) -> Column:
    out = F.lit(None)
    for k in KINDS:
        out = F.when(F.col("kind") == k, value(k)).otherwise(out)
    return out


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): ``rows(rid, doc_id)`` and the candidate spans ``(rid, kind, start, end, base, votes, traits)``.

    Offsets count code points.  The pass over the texts writes matches only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    cols = [_found(text, BASE[k], GATE[k](text)).alias(f"b_{k}") for k in KINDS]
    cols += [_found_ahead(text, MORE[k], GATE[f"more {k}"](text)).alias(f"m_{k}") for k in MORE]
    slim = written(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", *cols), "pii-matches")
    parts = None
    for name, kind, base in [(f"b_{k}", k, True) for k in KINDS] + [(f"m_{k}", k, False) for k in MORE]:
        part = slim.where(F.size(name) > 0).select("rid", F.lit(kind).alias("kind"), F.lit(base).alias("base"), F.posexplode(name).alias("i", "m"))
        parts = part if parts is None else parts.unionByName(part)
    run = Window.partitionBy("rid", "kind", "base").orderBy("i")
    size = F.length("m.hit")
    hit = F.col("hit")
    # the last hit lies before its end; hits of lookaheads lie behind the blank and may overlap
    upto = F.sum(F.col("m.gap") + F.when(F.col("base"), size).otherwise(0)).over(run)
    spans = (parts.withColumn("end", upto + F.when(F.col("base"), 0).otherwise(size - 1))
             .select("rid", "kind", "base", F.col("m.before").alias("before"), F.col("m.hit").alias("hit"), F.col("m.after").alias("after"),
                     (F.col("end") - size).alias("start"), "end")
             .where((F.col("kind") != "card") | (F.length(_digits(hit)) >= 12))
             .where((F.col("kind") != "card") | F.col("base") | luhn(_digits(hit)))
             .withColumn("valid", F.col("base") & _by_kind(lambda k: _valid(k, hit))))
    digits, lead = F.length(_digits(hit)), _digits(hit)
    in_run = F.col("before").rlike(r"[0-9]\.$") | F.col("after").rlike(r"^\.[0-9]")       # more dotted numbers beside it
    rule = F.when(~F.col("base"), "0").when(F.col("valid"), "+").otherwise("-")
    form = _by_kind(lambda k: {
        "email": _vote(hit.rlike(r"[.\])] ?[A-Za-z]{2,}$"), F.lit(True)),
        "ip": _vote(~hit.rlike(r"(^|[.\]) ])0[0-9]") & ~in_run, F.lit(True)),
        "card": _vote(digits.between(14, 19), F.lit(True)),
        "phone": _vote(digits.between(10, 15), F.lit(True))}[k])
    gazetteer = _by_kind(lambda k: {
        "email": _vote(hit.rlike(rf"(?i)[.\])] ?({DOMAINS})$"), F.lit(False)),
        "ip": _vote(~hit.rlike(r"^(0+|255|22[4-9]|23[0-9])[^0-9]"), F.lit(True)),
        "card": _vote(lead.rlike(f"^({ISSUERS})"), F.lit(True)),
        "phone": _vote(hit.rlike(rf"^\+({CALLING_CODES})(?![0-9])"), hit.startswith("+0"))}[k])
    context = _by_kind(lambda k: _vote(F.col("before").rlike(FOR_WORDS[k]), F.col("before").rlike(AGAINST_WORDS)))
    embedded = _vote(F.lit(False), F.col("before").rlike(r"[\p{L}0-9_]$") | F.col("after").rlike(r"^[\p{L}0-9_]")
                     | ((F.col("kind") == "ip") & in_run))
    shape = _by_kind(lambda k: {
        "email": _vote(F.length(hit).between(6, 64), F.lit(True)),
        "ip": _vote(hit.rlike(r"^[0-9.]{7,15}$|[\[(]"), F.lit(True)),
        "card": _vote(hit.rlike(r"^([0-9]+|[0-9]{4}([ -][0-9]{4}){2,3}[ -]?[0-9]{0,4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), F.lit(True)),
        "phone": _vote(hit.rlike(r"^(\+[0-9]{1,3}[ .-]?)?(\([0-9]{2,4}\)|[0-9]{2,4})([ .-]?[0-9]{2,4}){2,4}$"), F.lit(True))}[k])
    spans = spans.select("rid", "kind", "start", "end", F.col("valid").alias("base"),
                         F.concat(rule, form, gazetteer, context, embedded, shape).alias("votes"),
                         _traits(hit, F.col("before"), F.col("after")).alias("traits"))
    return slim.select("rid", "doc_id"), written(spans, "pii-spans")


def reliabilities(counts: list[tuple[str, str, int]], rounds: int = 30) -> dict[tuple[str, str], float]:
    """Probability that a candidate is personal data, per (kind, votes), by EM.

    Two classes per kind; every labelling function has its own table of
    P(vote | class), smoothed as if each had been right ``TRUST`` times and wrong once, which a
    rare vote leans on and a frequent one outgrows; the start is the balance of the votes.
    """
    out: dict[tuple[str, str], float] = {}
    for kind in {k for k, _, _ in counts}:
        rows = [(v, n) for k, v, n in counts if k == kind]
        post = {v: 1 / (1 + math.exp(-(v.count("+") - 2 * v.count("-")))) for v, _ in rows}
        for _ in range(rounds):
            prior, table = [1.0, 1.0], [[{"+": (1.0, TRUST)[y], "-": (TRUST, 1.0)[y], "0": 1.0} for _ in range(len(rows[0][0]))] for y in range(2)]
            for v, n in rows:
                for y, p in ((1, post[v]), (0, 1 - post[v])):
                    prior[y] += n * p
                    for j, c in enumerate(v):
                        table[y][j][c] += n * p
            for y in (0, 1):
                for t in table[y]:
                    s = sum(t.values())
                    for c in t:
                        t[c] /= s
            for v, _ in rows:
                logs = [math.log(prior[y]) + sum(math.log(table[y][j][c]) for j, c in enumerate(v)) for y in (0, 1)]
                post[v] = 1 / (1 + math.exp(max(-60.0, min(60.0, logs[0] - logs[1]))))
        out.update({(kind, v): p for v, p in post.items()})
    return out


Pattern = tuple[str, str, str, int]        # kind, votes, traits, number of candidates


def span_classifier(counts: list[Pattern], target: dict[tuple[str, str], float],
                    steps: int = 200, ridge: float = 1e-3) -> dict[tuple[str, str, str], float]:
    """Logistic regression on votes and traits within a kind, trained on the EM probabilities; its
    probability per pattern.

    The base rule's own vote is left out, so that the classifier speaks for
    candidates the rule does not cover.
    """
    def parts(kind: str, votes: str, traits: str) -> list:
        return [("kind", kind), *[(kind, "vote", j, c) for j, c in enumerate(votes) if j and c != "0"],
                *[(kind, "trait", j, c) for j, c in enumerate(traits)]]

    names = sorted({f for k, v, t, _ in counts for f in parts(k, v, t)}, key=str)
    at = {f: i for i, f in enumerate(names)}
    total = sum(n for *_, n in counts) or 1
    rows = [([at[f] for f in parts(k, v, t)], target[k, v], n / total) for k, v, t, n in counts]
    w, g2 = [0.0] * len(names), [1e-8] * len(names)
    for _ in range(steps):
        grad = [ridge * x / total for x in w]
        for f, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[i] for i in f)))))
            for i in f:
                grad[i] += n * (p - y)
        for i, g in enumerate(grad):
            g2[i] += g * g
            w[i] -= 0.5 * g / math.sqrt(g2[i])
    return {(k, v, t): 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[i] for i in f))))) for (k, v, t, _), (f, _, _) in zip(counts, rows)}


def vote_counts(counts: list[Pattern]) -> list[tuple[str, str, int]]:
    """(kind, votes, n): the patterns without their traits."""
    out: dict[tuple[str, str], int] = {}
    for k, v, _, n in counts:
        out[k, v] = out.get((k, v), 0) + n
    return [(k, v, n) for (k, v), n in sorted(out.items())]


def _of(kind: str):
    return lambda span: span["kind"] == kind


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added``.

    * null and empty texts have no spans and the digest of the empty string;
    * a span that the classifier adds never overlaps a base span of its kind, nor begins inside
      an earlier one that it accepts;
    * spans are sorted by start, then kind as listed; repeated rows and null
      ids stay; an empty table gives an empty result; further columns are ignored.
    """
    rows, spans = candidates(docs)
    counts = sorted(map(tuple, spans.groupBy("kind", "votes", "traits").agg(F.count("*").alias("n")).collect()))
    chance = span_classifier(counts, reliabilities(vote_counts(counts)))
    good = [f"{k}{v}{t}" for k, v, t, _ in counts if v[0] == "0" and chance[k, v, t] >= accept]
    added = F.concat("kind", "votes", "traits").isin(good) if good else F.lit(False)
    order = F.col("start"), F.desc("base"), F.desc("end")
    ahead = Window.partitionBy("rid", "kind").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("rid", "kind").orderBy(F.desc("start"), "base").rowsBetween(Window.unboundedPreceding, -1)
    kept = (spans.where(F.col("base") | added)
            .withColumn("past", F.max("end").over(ahead))
            .withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(back))
            .where(F.col("base") | ((F.coalesce("past", F.lit(-1)) <= F.col("start")) & F.coalesce(F.col("next") >= F.col("end"), F.lit(True)))))
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    listed = kept.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", number.alias("no"), "end", "kind", "base"))).alias("s"))
    write = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    none = F.expr("filter(array(named_struct('start', 0L, 'no', 0L, 'end', 0L, 'kind', '', 'base', false)), x -> false)")
    every = F.coalesce("s", none)
    base = F.filter(every, lambda x: x["base"])
    return (rows.join(listed, "rid", "left").select(
        "doc_id", *[F.size(F.filter(base, _of(k))).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(write(base), 256).alias("base_sha256"), write(every).alias("spans"),
        (F.size(every) - F.size(base)).cast("bigint").alias("n_added")))
