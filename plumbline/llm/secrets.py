"""Secret scan with linking of the parts of a credential. DataFrame functions only.

Base kinds are reported wherever they occur: `assign` (a named value), `access`
(an access identifier) and `hex` (a long hexadecimal run). Three weak kinds are
reported only beside complementary parts: `identifier` (a named account),
`weak_secret` (a bare mixed run of 40 characters, or a named value too short for
`assign`) and `endpoint` (a service address). Parts lie in the same scope when no
blank line parts them, and are linked by an interval join when at most REACH
code points lie between them:

- a weak identifier needs a secret, a weak secret needs an identifier;
- an endpoint needs a linked identifier or secret beside it.

Positions are code points with the end exclusive. They come from running sums
over the lengths of a text's matches and of what lies between them, so the work
is linear in the text. Null text counts as empty: no spans. Repeated rows get a
row each. Documents are told apart by two hashes of id and text.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.session import spool

REACH = 200
_NAMED = r"""["']?\x20*[:=]\x20*["']?"""
_ASSIGN = rf"((?i:password|passwd|secret|token|api_?key)){_NAMED}([A-Za-z0-9+/_.=-]+)"
# Kind: pattern, group measured, fewest characters of it. The base kinds come first.
KINDS = {
    "assign": (_ASSIGN, 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
    "identifier": (rf"((?i:access_?key_?id|client_?id|account_?id|user_?name)){_NAMED}([A-Za-z0-9+/_.@-]{{4,}})", 2, 4),
    "weak_secret": (
        r"""(?<![A-Za-z0-9+/=_"':-])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])""",
        0,
        40,
    ),
    "endpoint": (r"(?:https?|jdbc:[a-z]+|postgres|mysql|redis|mongodb|amqp|s3)://[^\x20\x09-\x0D\"'<>]+", 0, 8),
    "break": (r"\n[\x20\x09\r]*\n\s*", 0, 1),
}
BASE = ["assign", "access", "hex"]
WEAK_VALUE = 4


def _keys() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit("second"), F.col("text"), F.col("doc_id")).alias("_k2")]


def matches(df: DataFrame) -> DataFrame:
    """`_k1, _k2, kind, start, end, size`: all matches, also those that are too short, of the documents that matter.

    `size` is the number of characters of the measured group.
    """
    text = F.col("text")
    has = {k: F.rlike("text", F.lit(p)) for k, (p, _, _) in KINDS.items()}
    # Weak kinds matter only where an identifier and a secret may meet.
    df = df.withColumns({f"_has_{k}": has[k] for k in ("assign", "access", "hex")})
    found = {k: F.col(f"_has_{k}") for k in BASE}
    linked = (found["access"] | has["identifier"]) & (found["assign"] | has["weak_secret"])
    df = df.filter(found["assign"] | found["access"] | found["hex"] | linked).withColumn("_linked", linked)
    parts = []
    for kind, (pattern, group, _) in KINDS.items():
        p = F.lit(pattern)
        whole = F.regexp_extract_all(text, p, F.lit(0))
        part = F.regexp_extract_all(text, p, F.lit(group)) if group else whole
        rows = F.zip_with(
            F.zip_with(F.transform(F.split(text, pattern, -1), F.length), F.transform(whole, F.length), lambda g, m: F.struct(g.alias("gap"), m.alias("n"))),
            F.transform(part, F.length),
            lambda x, size: F.struct(F.lit(kind).alias("kind"), x["gap"].alias("gap"), x["n"].alias("n"), size.alias("size")),
        )
        parts.append(F.when(found.get(kind, F.col("_linked")), rows))
    rows = None
    for part in parts:
        # Each kind is numbered by itself; the last gap has no match after it.
        one = df.select(*_keys(), F.posexplode(part).alias("i", "m")).select("_k1", "_k2", "i", "m.*").filter("n IS NOT NULL")
        rows = one if rows is None else rows.union(one)
    rows = rows.dropDuplicates(["_k1", "_k2", "kind", "i"])
    before = W.partitionBy("_k1", "_k2", "kind").orderBy("i")
    end = F.sum((F.col("gap") + F.col("n")).cast("long")).over(before)
    return rows.select("_k1", "_k2", "kind", (end - F.col("n")).alias("start"), end.alias("end"), "size")


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of `left` with a row of `right` in their scope at most REACH code points away."""
    cells = F.explode(F.sequence(F.expr(f"(start - {REACH}) div {REACH} - 1"), F.expr(f"(end + {REACH}) div {REACH}")))
    reach = left.withColumn("_cell", cells)
    # A part lies in every cell it covers, so that long ones are met anywhere along them.
    own = F.explode(F.sequence(F.expr(f"start div {REACH}"), F.expr(f"end div {REACH}")))
    other = right.select("_k1", "_k2", "scope", F.col("start").alias("_s"), F.col("end").alias("_e"), own.alias("_cell"))
    near = (F.col("_s") <= F.col("end") + REACH) & (F.col("_e") >= F.col("start") - REACH)
    apart = (F.col("_s") >= F.col("end")) | (F.col("_e") <= F.col("start"))
    same = ["_k1", "_k2", "scope", "_cell"]
    on = functools.reduce(operator.and_, [reach[c] == other[c] for c in same]) & near & apart
    return reach.join(other, on, "left_semi").drop("_cell").distinct()


def linked_spans(found: DataFrame) -> DataFrame:
    """The weak spans that lie beside complementary parts."""
    order = W.partitionBy("_k1", "_k2").orderBy("start", "end", "kind")
    scoped = found.withColumn("scope", F.sum(F.when(F.col("kind") == "break", 1).otherwise(0)).over(order))
    scoped = spool(scoped.filter("kind NOT IN ('break', 'hex')"), "parts")
    long_enough = functools.reduce(lambda e, k: e.when(F.col("kind") == k, F.col("size") >= KINDS[k][2]), KINDS, F)
    short = (F.col("kind") == "assign") & (F.col("size") < KINDS["assign"][2])
    parts = scoped.withColumn("strong", F.col("kind").isin(BASE) & long_enough)
    parts = parts.filter(long_enough | short & (F.col("size") >= WEAK_VALUE))
    parts = parts.withColumn("kind", F.when(short, F.lit("weak_secret")).otherwise(F.col("kind")))
    identifiers, secrets = parts.filter("kind IN ('access', 'identifier')"), parts.filter("kind IN ('assign', 'weak_secret')")
    linked_identifiers, linked_secrets = _beside(identifiers, secrets), _beside(secrets, identifiers)
    anchors = linked_identifiers.union(linked_secrets)
    endpoints = _beside(parts.filter("kind = 'endpoint'"), anchors)
    return anchors.filter("NOT strong").union(endpoints).select("_k1", "_k2", "kind", "start", "end")


def spans(df: DataFrame) -> DataFrame:
    """`_k1, _k2, kind, start, end` of every span, once for rows that are equal in id and text."""
    found = spool(matches(df.select("doc_id", "text")), "matches")
    passing = functools.reduce(lambda e, k: e.when(F.col("kind") == k, F.col("size") >= KINDS[k][2]), BASE, F)
    base = found.filter(F.coalesce(passing, F.lit(False))).select("_k1", "_k2", "kind", "start", "end")
    return base.union(linked_spans(found))


def _count_of(kind: str) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def scan(df: DataFrame) -> DataFrame:
    """Counts and spans of every row, with the columns of `df` named `doc_id` and `text` only as input."""
    df = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = functools.reduce(lambda e, kn: e.when(F.col("kind") == kn[1], kn[0]), enumerate(KINDS), F)
    each = F.array_sort(F.collect_list(F.struct("start", place.alias("place"), "kind", "end")))
    shown = F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    base = F.filter("found", lambda s: s["place"] < len(BASE))
    base_shown = F.transform(base, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    number = {f"n_{k}": _count_of(k) for k in BASE}
    by = spans(df).groupBy("_k1", "_k2").agg(each.alias("found"))
    by = by.select(
        "_k1", "_k2", *[v.alias(k) for k, v in number.items()], F.array_join(base_shown, ",").alias("base"), F.array_join(shown, ",").alias("spans")
    )
    rows = df.select("doc_id", *_keys()).join(by, ["_k1", "_k2"], "left")
    return rows.select(
        "doc_id",
        *[F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in number],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def masked(df: DataFrame, mask: str) -> DataFrame:
    """The rows of `df` with every span replaced by `mask`, overlapping ones by one. `n_chars`, if there, follows the text."""
    order = W.partitionBy("_k1", "_k2").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    # Spans that overlap what came before them belong to the same mask.
    parted = spans(df.select("doc_id", "text")).withColumn("first", F.when(before.isNull() | (F.col("start") >= before), 1).otherwise(0))
    parted = parted.withColumn("mask", F.sum("first").over(order)).groupBy("_k1", "_k2", "mask")
    parted = parted.agg(F.min("start").alias("start"), F.max("end").alias("end"))
    found = parted.groupBy("_k1", "_k2").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_s"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    rows = df.select(row, *_keys()).join(found, ["_k1", "_k2"], "left")
    text, last = F.col("_row.text"), F.size("_s")
    # What stands between masks, by the end of the mask before it.
    between = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.substring(
            text,
            F.coalesce(F.get("_s", i - 1)["end"], F.lit(0)).cast("int") + 1,
            (F.coalesce(F.get("_s", i)["start"], F.length(text)) - F.coalesce(F.get("_s", i - 1)["end"], F.lit(0))).cast("int"),
        ),
    )
    rows = rows.withColumn("_text", F.when(F.col("_s").isNull(), text).otherwise(F.array_join(between, mask)))
    changed = {"text": F.col("_text")}
    if "n_chars" in df.columns:
        changed["n_chars"] = F.when(F.col("_s").isNull(), F.col("_row.n_chars")).otherwise(F.length("_text").cast("long"))
    return rows.select(*[changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`").alias(c) for c in df.columns])
