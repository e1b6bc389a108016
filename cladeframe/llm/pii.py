"""Personal data, by weak supervision.

Candidate spans of several kinds come from wide patterns. Three labelers vote on each, for (1), against (-1) or not at
all (0): a regex labeler checks the match strictly, a gazetteer labeler looks for known parts (mail domains, prefixes of
card numbers, dialling codes, token prefixes), and a context labeler reads the words before it. Spark counts the vote
patterns of all candidates of all texts; expectation-maximisation over these counts (their number is bounded by kinds
and votes, not by data) estimates for each kind how reliable each labeler is and how likely each pattern is; a logistic
classifier of spans is fitted to these likelihoods, and applied to every candidate as a column expression. Kinds are
estimated apart, patterns weigh by the logarithms of their counts, and the start follows the labelers' signs, so a few
true spans are found among any number of others. Matches of the base rules
are always kept; the classifier adds spans of the other kinds.

Positions count code points, end exclusive. Cases: a null text is empty. Repeated rows are treated alike. Very long texts are searched whole. Of spans that begin at one
place the kinds are listed in their fixed order, so there are no ties. A table without
candidates gives a classifier that adds nothing. An empty table gives an empty result. Other columns are ignored,
whatever their names. No shuffle but that of the vote counts. Native: DataFrame functions only.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

# The patterns match what the plain ones of the base rules match. Possessive quantifiers and a start at the end of the
# last match, or after a character that cannot belong, keep Java's matching linear and its stack flat.
MAIL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{MAIL})){MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+=*+",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
GUARDS = {
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}",
    "secret": r"[A-Za-z0-9_+/-]{20}", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
}
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "secret", "ssn")
KINDS = BASE + ADDED
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CONTEXT = 40
#: Candidates of each truth that the prior counts for, and how votes fall among them, by vote and truth.
PRIOR = 100.0
#: The start, by sum of votes: what speaks for a span more than against it.
START = {-3: 0.01, -2: 0.01, -1: 0.02, 0: 0.1, 1: 0.5, 2: 0.95, 3: 0.99}
#: How votes fall in the prior.
TRUST = {(1, 1): 0.6, (0, 1): 0.35, (-1, 1): 0.05, (1, 0): 0.1, (0, 0): 0.45, (-1, 0): 0.45}
#: Parts that speak for a kind, and words before a span that speak for or against it.
GAZETTEER = {
    "email": r"(?i)@(?:.*\.)?(?:gmail|outlook|hotmail|yahoo|icloud|proton(?:mail)?|gmx|web|mail|example)\.",
    "ip": r"^(?:10|127|172|192)\.", "card": r"^(?:4|5[1-5]|34|37|6011|65)", "phone": r"^\+(?:1|33|34|39|44|49|81|86|91)(?![0-9]{12})",
    "iban": r"^(?:AT|BE|CH|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)", "secret": r"^(?:AKIA|ghp_|gho_|sk-|xox[bp]-|eyJ|glpat-)", "ssn": r"^(?!000|666|9)",
}
CUES = {
    "email": r"e-?mail|contact|write to|mailto|reach", "ip": r"\bip\b|address|host|server|client|login", "card": r"card|visa|mastercard|credit|debit|payment",
    "phone": r"phone|call|tel|mobile|fax|cell", "iban": r"iban|account|bank|transfer", "secret": r"token|secret|passw|key|bearer|auth|credential", "ssn": r"ssn|social security|social-security",
}
AGAINST = r"version|release|isbn|issn|figure|table|section|chapter|sha-?[0-9]*\W*$|md5|commit|checksum|digest|order no|part no"


def found(text: Column, kind: str) -> Column:
    """array<struct<start, end, m>> of all matches: pieces between matches give their places."""
    zero = F.lit(0)
    span = "struct<start:int,end:int,m:string>"
    none = F.array().cast(f"array<{span}>")

    def places(ms: Column) -> Column:
        def joined(ps: Column) -> Column:
            start = F.struct(zero.alias("at"), none.alias("own"), F.array().cast(f"array<array<{span}>>").alias("full"))

            def step(acc: Column, i: Column) -> Column:
                a = acc["at"] + F.length(F.get(ps, i))
                b = a + F.length(F.get(ms, i))
                one = F.struct(a.alias("start"), b.alias("end"), F.get(ms, i).alias("m"))
                whole = F.size(acc["own"]) >= 255
                own = F.concat(acc["own"], F.array(one))
                return F.struct(b.alias("at"), F.when(whole, none).otherwise(own).alias("own"), F.when(whole, F.concat(acc["full"], F.array(own))).otherwise(acc["full"]).alias("full"))

            return F.aggregate(F.sequence(zero, F.size(ms) - 1), start, step, lambda acc: F.concat(F.flatten(acc["full"]), acc["own"]))

        return F.when(F.size(ms) == 0, none).otherwise(bind(F.split(text, PATTERNS[kind], -1), joined))

    guard = F.contains(text, F.lit("@")) if kind == "email" else text.rlike(GUARDS[kind])
    if kind == "phone":
        guard = F.contains(text, F.lit("+")) & guard
    return F.when(guard, bind(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), places)).otherwise(none)


def strict(m: Column, kind: str) -> Column:
    """The check that decides base matches, and the regex labeler's vote for all."""
    digits = F.regexp_replace(m, r"[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}\z"),
        "card": F.length(digits).between(16, 19) & F.call_function("luhn_check", F.when(F.length(digits) <= 19, digits).otherwise(F.lit("1"))),
        "phone": F.length(digits).between(8, 15),
        "iban": F.length(F.replace(m, F.lit(" "))).between(15, 34),
        "secret": m.rlike(r"^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})\z") | (m.rlike(r"[0-9]") & m.rlike(r"[a-z]") & m.rlike(r"[A-Z]")),
        "ssn": m.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}\z"),
    }[kind]


def candidates(text: Column, kind: str) -> Column:
    """array<struct<kind, start, end, base, v1, v2, v3>>."""

    def one(x: Column) -> Column:
        m = x["m"]
        before = F.lower(F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT))))
        ok = strict(m, kind)
        return F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), (ok if kind in BASE else F.lit(False)).alias("base"),
            F.when(ok, 1).otherwise(-1).alias("v1"),
            F.when(m.rlike(GAZETTEER[kind]), 1).otherwise(0).alias("v2"),
            F.when(before.rlike(AGAINST), -1).when(before.rlike(CUES[kind]), 1).otherwise(0).alias("v3"),
        )

    return F.transform(found(text, kind), one)


def estimate(counts: dict[tuple, int], rounds: int = 50) -> dict[tuple, float]:
    """Expectation-maximisation over vote patterns (kind, v1, v2, v3): how likely each is personal data. Every kind is a mixture of its own, with
    its share and its labelers' reliabilities. A pattern weighs by the logarithm of its count, so that a thousand times as
    many candidates of one pattern don't turn what the others say. The prior, of PRIOR such candidates, says that
    labelers are right more often than not and keeps the two classes from changing places."""
    belief = {p: START[sum(p[1:])] for p in counts}
    for kind in {p[0] for p in counts}:
        own = {p: math.log1p(n) for p, n in counts.items() if p[0] == kind}
        for _ in range(rounds):
            share = [PRIOR, PRIOR]
            votes = {(k, v, y): PRIOR * trust for k in range(3) for (v, y), trust in TRUST.items()}
            for p, n in own.items():
                for y, w in ((1, belief[p] * n), (0, (1 - belief[p]) * n)):
                    share[y] += w
                    for k, v in enumerate(p[1:]):
                        votes[k, v, y] += w
            total = {(k, y): sum(votes[k, v, y] for v in (-1, 0, 1)) for k in range(3) for y in (0, 1)}
            for p in own:
                odds = [math.log(share[y] / sum(share)) + sum(math.log(votes[k, v, y] / total[k, y]) for k, v in enumerate(p[1:])) for y in (0, 1)]
                belief[p] = 1 / (1 + math.exp(max(-500, min(500, odds[0] - odds[1]))))
    return belief


def features(kind: str, votes: tuple) -> list[str]:
    """Each vote counts for all kinds and once more for its own."""
    return ["bias", f"kind={kind}", *[f"v{k}={v}" for k, v in enumerate(votes, 1)], *[f"{kind}:v{k}={v}" for k, v in enumerate(votes, 1)]]


def fit(counts: dict[tuple, int], belief: dict[tuple, float], rounds: int = 2000, rate: float = 0.5, decay: float = 1e-3) -> dict[str, float]:
    """Logistic classifier of spans on kind and votes, fitted to the beliefs. A pattern weighs by the logarithm of its count,
    so common ones don't drown the others."""
    known = {p: features(p[0], p[1:]) for p in counts}
    weight: dict[str, float] = defaultdict(float)
    mass = {p: math.log1p(n) for p, n in counts.items()}
    whole = sum(mass.values()) or 1.0
    for _ in range(rounds):
        slope: dict[str, float] = defaultdict(float)
        for p, own in known.items():
            guess = 1 / (1 + math.exp(-max(-500, min(500, sum(weight[f] for f in own)))))
            for f in own:
                slope[f] += mass[p] * (belief[p] - guess) / whole
        for f in slope:
            weight[f] += rate * (slope[f] - decay * weight[f])
    return dict(weight)


def vote_counts(docs: DataFrame, text_col: str = "text") -> dict[tuple, int]:
    text = F.coalesce(docs[text_col], F.lit(""))
    every = docs.select(text.alias("text")).select(F.explode(F.concat(*[candidates(F.col("text"), k) for k in KINDS])).alias("c"))
    rows = every.groupBy("c.kind", "c.v1", "c.v2", "c.v3").count().collect()  # at most 7 * 27 rows
    return {(r.kind, r.v1, r.v2, r.v3): r["count"] for r in rows}


def personal_data(docs: DataFrame, weights: dict[str, float] | None = None, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans, base) for every row, both array<struct<kind, start, end, score>>, in order of KINDS and start. Without
    weights the classifier is trained on all candidates of docs first."""
    if weights is None:
        counts = dict(sorted(vote_counts(docs, text_col).items()))
        weights = fit(counts, estimate(counts)) if counts else {}
    table = F.create_map(*[F.lit(x) for pair in ({"": 0.0} | weights).items() for x in pair])

    def scored(c: Column) -> Column:
        votes = [F.concat(F.lit(f"v{k}="), c[f"v{k}"].cast("string")) for k in (1, 2, 3)]
        names = [F.lit("bias"), F.concat(F.lit("kind="), c["kind"]), *votes, *[F.concat(c["kind"], F.lit(":"), v) for v in votes]]
        z = reduce(lambda a, b: a + b, [F.coalesce(F.try_element_at(table, n), F.lit(0.0)) for n in names])
        return F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), (1 / (1 + F.exp(-z))).alias("score"), c["base"].alias("base"))

    text = F.coalesce(docs[text_col], F.lit(""))
    out = docs.select(docs[id_col].alias("id"), text.alias("text")).select("id", *[candidates(F.col("text"), k).alias(k) for k in KINDS])
    base = F.concat(*[F.filter(F.col(k), lambda c: c["base"]) for k in BASE])
    added = F.concat(*[F.filter(F.transform(F.col(k), scored), lambda c: c["score"] > threshold) for k in ADDED])
    slim = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["score"].alias("score"))
    out = out.select("id", F.transform(F.transform(base, scored), slim).alias("base"), F.transform(added, slim).alias("added"))
    return out.select(F.col("id").alias(id_col), F.concat("base", "added").alias("spans"), "base")


def redact(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the spans of each id replaced by [kind]; overlapping spans are cut at the end of the earlier. Ids must be unique."""
    own = spans.select(F.col(id_col).alias("__id"), F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["end"], s["kind"]))).alias("__spans"))
    both = docs.join(own, docs[id_col] == F.col("__id"), "left")
    text, start = docs[text_col], F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        later = s["start"] >= acc["at"]
        kept = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(later, F.concat(acc["out"], kept, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["out"]).alias("out"))

    spans_of = F.coalesce("__spans", F.array().cast("array<struct<start:int,end:int,kind:string>>"))
    new = F.aggregate(spans_of, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return both.select(*[(F.when(text.isNull(), text).otherwise(new)).alias(c) if c == text_col else docs[c] for c in docs.columns])
