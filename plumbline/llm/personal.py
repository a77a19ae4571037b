"""Personal data by weak supervision. DataFrame functions only.

Base kinds are reported wherever they occur: `email`, `ip`, `card`, `phone`. Five
added kinds are reported where a classifier says so: `name` (capitalised words),
`spoken_email` (with "at" and "dot" written out), `local_phone` (without a country
code), `national_id` and `iban`.

1. Candidates of the added kinds come from one scan with wide patterns.
2. Labelers vote on each: regular expressions (well or badly formed), gazetteers
   (given names, account countries and top-level domains for it; names of things
   against it) and context (a cue or a counter-cue before it, contact data beside
   it, text it is part of). A labeler fires or abstains.
3. Expectation-maximisation on the votes estimates, for each kind, how often each
   labeler fires on personal data and on other text, and how likely each pattern
   of votes is personal data. Labelers keep their direction: one that speaks for
   personal data is never taken to speak against it.
4. These likelihoods train a logistic classifier on votes and shape. A candidate
   is reported if the classifier says at least one half and a labeler is for it.

Candidates are counted by kind, votes and shape, at most `len(ADDED) * 2 ** (votes
+ shapes)` rows whatever the corpus, and both models are fitted on all of these
counts, with one small aggregation a step. Only fitted numbers, one row for each
kind, reach the driver.

Positions are code points with the end exclusive. Null text counts as empty: no
spans. Repeated rows get a row each, null ids stay null. An empty table gives no
rows. Columns of the input other than `doc_id` and `text` are ignored, whatever
their names. Patterns are possessive and bound to the start of a run, so long
runs cost linear time; positions cost the number of a text's matches to the 1.5.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import spool

BASE = ["email", "ip", "card", "phone"]
# A run of the first class holds at most one start, but a match may also begin where the last one ended.
_RUN = r"(?:(?<![A-Za-z0-9._%+-])|\G)"
PATTERNS = {
    "email": _RUN + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text needs to have a match that passes, cheap to look for.
NEEDS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

ADDED = ["name", "spoken_email", "local_phone", "national_id", "iban"]
_AT, _DOT = r"\x20?[\[(]at[\])]\x20?", r"(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)"
CANDIDATES = {
    "name": r"(?<![\p{L}\p{N}])\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)++(?![\p{L}\p{N}])",
    "spoken_email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++)",
    "local_phone": r"(?<![0-9+.-])(?<!\+[0-9]{1,3}[\x20.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
ANY = "|".join(CANDIDATES[k] for k in ["iban", "national_id", "local_phone", "spoken_email", "name"])
# The kind of a candidate, told from its own text, the first that fits.
TOLD = {"iban": "^[A-Z]{2}[0-9]{2}", "national_id": "^[0-9]{3}-[0-9]{2}-", "local_phone": r"^[(0-9][0-9()\x20.-]+$", "spoken_email": r"[\x20\[(]at[\x20\])]", "name": ""}
BEFORE, AFTER = 40, 20

GIVEN = """Adam Alice Alexander Ana Andrea Andreas Angela Anna Anne Anthony Antonio Barbara Benjamin Bernd Brian Camille Carlos Carmen Carol
Caroline Catherine Charles Charlotte Chloe Christian Christine Christopher Claire Claudia Daniel David Deborah Diana Dieter Donald Edward Elena
Elizabeth Emily Emma Eric Eva Francisco Frank Friedrich Gabriel George Gerhard Hannah Hans Heinrich Helen Isabel Jack Jacques James Jane Javier
Jean Jennifer Jessica Johann John Jonathan Jorge Joseph Juan Julia Karen Karl Katharina Kevin Klaus Laura Linda Louis Lucas Lucia Luis Manuel
Margaret Maria Marie Mark Martin Mary Matthew Michael Michelle Miguel Monika Nancy Nathalie Nicolas Nicole Olivia Pablo Patricia Patrick Paul
Pedro Peter Philippe Pierre Rachel Rebecca Richard Robert Sabine Samuel Sandra Sarah Sebastian Sofia Sophie Stefan Stephen Steven Susan Thomas
Ursula Victor Victoria Walter William Wolfgang""".split()
THINGS = """License Licence Public Version Apache Software Foundation General Commons University Institute Street Avenue Road Company Inc Ltd Corp
January February March April June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday
North South East West United States Kingdom New City County River Lake Mount Section Chapter Table Figure Copyright Rights Terms Privacy Policy""".split()
COUNTRIES = {"AT": 20, "BE": 16, "CH": 21, "DE": 22, "ES": 24, "FR": 27, "GB": 22, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "PL": 28, "PT": 25, "SE": 24}
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "us"]
CUES = {
    "name": r"(?:\b(?i:name|names|called|contact|signed|sincerely|author|mrs|herr|frau|madame|monsieur|señora?|don|doña)|\b(?:Mr|Ms|Dr|Prof|Mme|Sr|Sra|M)\b)[.:]?\s*$",
    "spoken_email": r"(?i:\b(?:e-?mail|mail|contact|write|reach|correo|courriel)\b[^\n]{0,20})$",
    "local_phone": r"(?i:\b(?:phone|tel|telephone|call|fax|mobile|cell|telefon|teléfono|téléphone)\b[^\n0-9]{0,15})$",
    "national_id": r"(?i:\b(?:ssn|social security|tax id|national id)\b[^\n0-9]{0,15})$",
    "iban": r"(?i:\b(?:iban|account|konto|cuenta|compte)\b[^\n0-9]{0,15})$",
}
COUNTER = r"(?i:\b(?:version|release|isbn|issn|rfc|section|article|chapter|invoice|order|serial|model|part|page|figure|table|build|ticket|seite)\b[^\p{L}\p{N}]{0,4}|#)$"
CONTACT = r"@[A-Za-z0-9-]+\.|\+[0-9][\x20().0-9-]{7}|(?i:\b(?:phone|tel|e-?mail|address|born)\b)"
PART_BEFORE, PART_AFTER = r"[\p{L}\p{N}_/#=.-]$", r"^(?:[/_@=-]|\.[\p{L}\p{N}])"
VALID = {
    "spoken_email": r"[\x20\])(.\[][A-Za-z]{2,6}$",
    "local_phone": r"^\(?[2-9][0-9]{2}[).-]+\x20?[2-9][0-9]{2}[.-][0-9]{4}$",
    "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
}
TITLE = r"(?:^|\x20)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\x20\S"
# Five words or more, or a word twice.
BAD_NAME = r"^(?:\S++\x20){4}|(?:^|\x20)(\S++)\x20(?:\S++\x20)*\1(?:\x20|$)"
# Votes in the order of their bits, with their direction; what they fire at rates of before any data, on personal data and on other text.
VOTES = {"formed": 1, "malformed": -1, "known": 1, "thing": -1, "cue": 1, "counter": -1, "contact": 1, "part": -1}
PRIOR_RATES = {1: (0.6, 0.05), -1: (0.05, 0.4)}
PRIOR_ROWS, PRIOR_SHARE, PRIOR_SHARE_ROWS = 10.0, 0.2, 5.0
SHAPES = ["short", "long", "line_start", "stopped", "introduced"]
FEATURES = [*ADDED, *VOTES, *SHAPES]
ROUNDS, STEPS, STEP, SHRINK = 20, 60, 0.4, 1e-3


def _either(words: list[str]) -> str:
    return r"(?:^|\x20)(?:" + "|".join(words) + r")(?:\x20|$)"


def _is(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(pattern))


def _by_kind(kind: Column, cases: dict[str, Column]) -> Column:
    """The case of the kind; false where it has none."""
    return functools.reduce(lambda e, k: e.when(kind == k, cases[k]), cases, F).otherwise(F.lit(False))


def _account(text: Column) -> Column:
    return F.regexp_replace(text, r"\x20", "")


def account_checks(text: Column) -> Column:
    """Whether an account number's check digits hold: the number, its first four characters last and letters as 10 to 35, leaves 1 by 97."""
    plain = _account(text)
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    codes = F.transform(F.split(turned, ""), F.ascii)
    rest = F.aggregate(codes, F.lit(0), lambda rest, c: (rest * F.when(c > 64, 100).otherwise(10) + F.when(c > 64, c - 55).otherwise(c - 48)) % 97)
    return rest == 1


def votes(c: Column) -> dict[str, Column]:
    """What each labeler says of a candidate with `kind`, `text`, `before` and `after`: fires, or not."""
    kind, text = c["kind"], c["text"]
    formed = {k: _is(text, p) for k, p in VALID.items()} | {"iban": account_checks(text)}
    countries = F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair])
    return {
        "formed": _by_kind(kind, formed),
        "malformed": _by_kind(kind, {"name": _is(text, BAD_NAME)} | {k: ~v for k, v in formed.items()}),
        "known": _by_kind(
            kind,
            {
                "name": _is(text, _either(GIVEN)),
                "spoken_email": F.regexp_extract(text, "([A-Za-z0-9-]+)$", 1).isin(DOMAINS),
                "iban": F.coalesce(F.element_at(countries, F.substr(text, F.lit(1), F.lit(2))) == F.length(_account(text)), F.lit(False)),
            },
        ),
        "thing": _by_kind(kind, {"name": _is(text, _either(THINGS))}),
        "cue": _by_kind(kind, {k: _is(c["before"], p) for k, p in CUES.items()} | {"name": _is(c["before"], CUES["name"]) | _is(text, TITLE)}),
        "counter": _is(c["before"], COUNTER),
        "contact": _is(c["before"], CONTACT) | _is(c["after"], CONTACT),
        "part": _is(c["before"], PART_BEFORE) | _is(c["after"], PART_AFTER),
    }


def shapes(c: Column) -> dict[str, Column]:
    size = F.length(c["text"])
    return {
        "short": size <= 10,
        "long": size > 24,
        "line_start": _is(c["before"], r"(?:^|\n)[\x20\t]*$"),
        "stopped": _is(c["after"], r"^(?:$|[,;)\n])"),
        "introduced": _is(c["before"], r"[:(<]\x20?$"),
    }


def _bits(said: dict[str, Column]) -> Column:
    return functools.reduce(operator.add, [F.when(v, 1 << i).otherwise(0) for i, v in enumerate(said.values())])


def _passes(kind: str, text: Column) -> Column:
    digits = F.regexp_replace(text, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": _is(text, IP_PARTS),
        "card": F.length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(9, 15),
    }[kind]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def candidates(df: DataFrame) -> DataFrame:
    """The rows of `df` as `doc_id`, matches of each base kind and candidates, each with its length and the gap before it; stored."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def base(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
        gaps = F.transform(F.split(text, PATTERNS[kind], -1), F.length)
        rows = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), F.length(m).alias("n"), _passes(kind, m).alias("ok")))
        # What comes after the last match has none of its own.
        return F.when(_is(text, NEEDS[kind]), F.filter(rows, lambda r: r["n"].isNotNull())).alias(kind)

    def seen(parts: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
        told = lambda m: functools.reduce(lambda e, k: e.when(_is(m, TOLD[k]), F.lit(k)), TOLD, F)
        with_gap = F.zip_with(parts, found, lambda g, m: F.struct(g.alias("gap"), m.alias("text"), told(m).alias("kind")))
        rows = F.zip_with(
            F.filter(with_gap, lambda r: r["text"].isNotNull()),
            F.slice(parts, 2, F.size(parts) - 1),
            lambda r, after: F.struct(
                r["text"].alias("text"),
                r["kind"].alias("kind"),
                F.length(r["gap"]).alias("gap"),
                F.right(r["gap"], F.lit(BEFORE)).alias("before"),
                F.left(after, F.lit(AFTER)).alias("after"),
            ),
        )
        return F.transform(
            rows,
            lambda r: F.struct(r["gap"], F.length(r["text"]).alias("n"), r["kind"], _bits(votes(r)).alias("votes"), _bits(shapes(r)).alias("shape")),
        )

    added = F.when(_is(text, ANY), _let(F.split(text, ANY, -1), seen)).alias("added")
    return spool(df.select(F.col("doc_id").cast("long").alias("doc_id"), *map(base, BASE), added), "candidates")


def _bit(name: str, of: str = "") -> str:
    """SQL for 1 where a feature holds of `kind, votes, shape`, fields of `of`, else 0."""
    if name in ADDED:
        return f"CAST({of}kind = '{name}' AS INT)"
    names, column = (list(VOTES), "votes") if name in VOTES else (SHAPES, "shape")
    return f"(shiftright({of}{column}, {names.index(name)}) & 1)"


def _logit(p: float) -> float:
    return math.log(p) - math.log1p(-p)


def _posterior(share: dict[str, float], rates: dict[str, dict[str, tuple[float, float]]]) -> str:
    """SQL for the likelihood that a pattern of votes is personal data."""
    cases = []
    for kind in ADDED:
        terms = [repr(_logit(share[kind]))]
        for vote, (own, other) in rates[kind].items():
            fired, silent = math.log(own / other), math.log1p(-own) - math.log1p(-other)
            terms.append(f"CASE WHEN {_bit(vote)} = 1 THEN {fired!r}D ELSE {silent!r}D END")
        cases.append(f"WHEN kind = '{kind}' THEN {' + '.join(terms)}")
    return f"1D / (1D + exp(-(CASE {' '.join(cases)} END)))"


def _directed(vote: str, own: float, other: float) -> tuple[float, float]:
    """Rates of firing that agree with the labeler's direction: twice as often on its own side."""
    own, other = min(0.99, max(0.01, own)), min(0.99, max(0.01, other))
    if VOTES[vote] > 0:
        return max(own, min(0.95, 2 * other)), min(other, 0.475)
    return min(own, 0.475), max(other, min(0.95, 2 * own))


def reliabilities(patterns: DataFrame) -> tuple[dict, dict]:
    """Share of personal data and rates of firing by kind, by expectation-maximisation over `kind, votes, shape, w`."""
    share = dict.fromkeys(ADDED, PRIOR_SHARE)
    rates = {k: {v: PRIOR_RATES[d] for v, d in VOTES.items()} for k in ADDED}
    for _ in range(ROUNDS):
        fired = [F.expr(f"sum(w * r * {_bit(v)})").alias(f"own_{v}") for v in VOTES] + [F.expr(f"sum(w * {_bit(v)})").alias(f"all_{v}") for v in VOTES]
        sums = patterns.withColumn("r", F.expr(_posterior(share, rates))).groupBy("kind").agg(F.expr("sum(w)").alias("n"), F.expr("sum(w * r)").alias("own"), *fired)
        before = share, rates
        share, rates = dict(share), dict(rates)
        for s in sums.collect():
            share[s["kind"]] = min(0.95, (s["own"] + PRIOR_SHARE * PRIOR_SHARE_ROWS) / (s["n"] + PRIOR_SHARE_ROWS))
            rates[s["kind"]] = {
                v: _directed(
                    v,
                    (s[f"own_{v}"] + PRIOR_RATES[d][0] * PRIOR_ROWS) / (s["own"] + PRIOR_ROWS),
                    (s[f"all_{v}"] - s[f"own_{v}"] + PRIOR_RATES[d][1] * PRIOR_ROWS) / (s["n"] - s["own"] + PRIOR_ROWS),
                )
                for v, d in VOTES.items()
            }
        if (share, rates) == before:
            break
    return share, rates


def classifier(patterns: DataFrame, share: dict, rates: dict) -> dict[str, float]:
    """Weights of FEATURES: logistic regression on the likelihoods, the two sides of each kind at equal weight.

    The kinds' own weights then take in how common personal data is among their candidates.
    """
    rows = patterns.withColumn("r", F.expr(_posterior(share, rates)))
    masses = {m["kind"]: (m["own"], m["n"] - m["own"]) for m in rows.groupBy("kind").agg(F.expr("sum(w * r)").alias("own"), F.expr("sum(w)").alias("n")).collect()}
    weights = dict.fromkeys(FEATURES, 0.0)
    if not masses:
        return weights
    sides = [
        "CASE " + " ".join(f"WHEN kind = '{k}' THEN {0.5 / (len(masses) * max(m[side], 1e-9))!r}D" for k, m in masses.items()) + " END" for side in (0, 1)
    ]
    rows = rows.select("kind", "votes", "shape", F.expr(f"w * r * {sides[0]}").alias("for"), F.expr(f"w * (1 - r) * {sides[1]}").alias("against"))
    ahead = dict(weights)
    for step in range(STEPS):
        score = " + ".join(f"{w!r}D * {_bit(f)}" for f, w in ahead.items())
        error = rows.withColumn("p", F.expr(f"1D / (1D + exp(-({score})))")).withColumn("e", F.expr("(`for` + against) * p - `for`"))
        slope = error.agg(*[F.expr(f"sum(e * {_bit(f)})").alias(f) for f in FEATURES]).first()
        moved = {f: ahead[f] - STEP * (slope[f] + SHRINK * ahead[f]) for f in FEATURES}
        ahead = {f: moved[f] + step / (step + 3) * (moved[f] - weights[f]) for f in FEATURES}
        weights = moved
    for kind, (own, other) in masses.items():
        weights[kind] += math.log(max(own, 1e-9)) - math.log(max(other, 1e-9))
    return weights


def fitted(found: DataFrame) -> dict[str, float]:
    """Weights of the classifier for the candidates of a corpus."""
    patterns = found.select(F.explode("added").alias("c")).groupBy("c.kind", "c.votes", "c.shape").agg(F.count("*").cast("double").alias("w"))
    # One small file, read in one order, so that sums repeat to the last digit.
    patterns = spool(patterns.repartition(1).sortWithinPartitions("kind", "votes", "shape"), "patterns")
    return classifier(patterns, *reliabilities(patterns))


def _located(rows: Column) -> Column:
    """Adds `start` and `end` to matches in the order of the text, by sums over blocks of the square root of their number."""
    lengths = F.transform(rows, lambda r: (r["gap"] + r["n"]).cast("long"))
    zero = F.lit(0).cast("long")

    def with_sums(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), (F.size(s["x"]) / s["b"]).cast("int"))
        return F.struct(s["x"].alias("x"), s["b"].alias("b"), F.transform(blocks, lambda k: F.aggregate(F.slice(s["x"], 1, k * s["b"]), zero, operator.add)).alias("sums"))

    def place(s: Column) -> Column:
        def end(i: Column) -> Column:
            block = (i / s["b"]).cast("int")
            return F.get(s["sums"], block) + F.aggregate(F.slice(s["x"], block * s["b"] + 1, i % s["b"] + 1), zero, operator.add)

        ended = F.transform(s["x"], lambda _, i: end(i))
        return F.zip_with(rows, ended, lambda r, e: F.struct((e - r["n"]).alias("start"), e.alias("end"), r.alias("row")))

    sized = F.struct(lengths.alias("x"), F.ceil(F.sqrt(F.greatest(F.size(lengths), F.lit(1)))).cast("int").alias("b"))
    return F.when(rows.isNotNull() & (F.size(rows) > 0), _let(_let(sized, with_sums), place))


def spans(df: DataFrame) -> DataFrame:
    """`doc_id` and `spans`, an array of kind, start and end, of every row: base kinds as listed, then added ones, each by start."""
    found = candidates(df.select("doc_id", "text"))
    weights = fitted(found)
    score = " + ".join(f"{weights[f]!r}D * {_bit(f, 'c.row.')}" for f in FEATURES)
    supported = " + ".join(_bit(v, "c.row.") for v, d in VOTES.items() if d > 0)
    reported = F.expr(f"filter(added, c -> {score} >= 0 AND {supported} > 0)")
    located = found.select("doc_id", *[_located(F.col(k)).alias(k) for k in [*BASE, "added"]]).withColumn("added", reported)

    def kept(kind: str) -> Column:
        found = F.filter(kind, lambda c: c["row"]["ok"]) if kind in BASE else F.filter("added", lambda c: c["row"]["kind"] == kind)
        return F.transform(found, lambda c: F.struct(F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))

    empty = F.expr("CAST(array() AS array<struct<kind:string,start:bigint,end:bigint>>)")
    return located.select("doc_id", F.concat(*[F.coalesce(kept(k), empty) for k in [*BASE, *ADDED]]).alias("spans"))


def scan(df: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans of every row."""
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return spans(df).select("doc_id", *map(number, BASE), F.sha2(shown(base).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))
