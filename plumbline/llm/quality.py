"""Quality rules with cutoffs that follow each language and source.

Fixed rules come first: at least 50 words, at most half of them in repeated
three-word windows. The other rules compare four shares of a document, in
thousandths, with cutoffs taken from the upper tails of quantile sketches of the
documents that pass the fixed rules:

    cutoff = tail + (tail - median) / 2 + TIE_GUARD

`tail` is the share's upper percentile in SHARES: where spam is common among the
documents, as with symbols, one well within the ordinary documents. A group's
cutoff is at most LIFT times that of its language, and a language's at most LIFT
times that of all documents, so a group full of spam can't lift its own. The
guard only keeps values apart that fall into one bucket or differ by rounding.

A sketch is a table of counts by bucket, with buckets of five significant bits,
so sketches are merged by adding counts, in any order, with equal results. The
sketch of a language and source is used from MIN_DOCUMENTS on; below that those of the
whole language, and then of all documents, take its place.

Null text has no words and fails. Null language or source is a group like any
other. Repeated rows count and are returned each. An empty table gives no rows.
"""

from __future__ import annotations

import re
import string

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.frames import map_rows
from plumbline.session import spool

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCUMENTS = 200
TIE_GUARD = 5
LIFT = 2
# Shares in thousandths: numerator, denominator, percentile of the tail.
SHARES = {
    "symbols": ("n_symbols", "word_chars", 90),
    "capitals": ("n_capitals", "word_chars", 99),
    "dup_lines": ("n_dup_lines", "n_lines", 99),
    "repeats": ("n_repeat_words", "n_words", 99),
}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL_CHARS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def repeated_words(words: list[str]) -> int:
    """Words that lie in a three-word window found more than once."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: set[tuple] = set()
    often = {w for w in windows if w in seen or seen.add(w)}
    covered = bytearray(len(words))
    for i, w in enumerate(windows):
        if w in often:
            covered[i : i + 3] = b"\1\1\1"
    return sum(covered)


def counts_of(text: str | None) -> tuple[int, ...]:
    """The numbers named in COUNTS."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, _SYMBOL_CHARS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(text.count, string.ascii_uppercase)),
    )


def measured(df: DataFrame) -> DataFrame:
    """`doc_id, lang, source`, the counts and whether the fixed rules fail."""

    def make():
        def run(batch):
            counts = zip(*map(counts_of, batch["text"])) if batch["text"] else [[] for _ in COUNTS]
            return {k: batch[k] for k in ("doc_id", "lang", "source")} | dict(zip(COUNTS, map(list, counts)))

        return run

    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS)
    columns = [df["doc_id"].cast("long"), df["lang"].cast("string"), df["source"].cast("string"), df["text"]]
    return with_shares(map_rows(df.select(*columns), make, schema))


def with_shares(df: DataFrame) -> DataFrame:
    few, repeats = F.col("n_words") < MIN_WORDS, 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    shares = {f"s_{k}": F.expr(f"1000 * {a} div greatest({b}, 1)") for k, (a, b, _) in SHARES.items()}
    return df.withColumn("base_failed", few | repeats).withColumns(shares)


def sketch(df: DataFrame) -> DataFrame:
    """Counts by language, source, share and bucket."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("share"), F.col(f"s_{k}").alias("v")) for k in SHARES]))
    rows = df.filter("NOT base_failed").select("lang", "source", each.alias("e")).select("lang", "source", "e.*")
    shift = "cast(greatest(length(bin(v)) - 5, 0) AS int)"
    bucket = F.expr(f"shiftleft(shiftright(v, {shift}), {shift})")
    return rows.groupBy("lang", "source", "share", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def cutoffs(sketches: DataFrame) -> DataFrame:
    """`lang, source, share, cutoff` for each group of the sketches."""
    sketches = spool(sketches, "sketch")
    tail = F.create_map(*[F.lit(x) for k, (_, _, p) in SHARES.items() for x in (k, p)])[F.col("share")]
    levels = []
    for level, keys in enumerate((["lang", "source"], ["lang"], [])):
        merged = sketches.groupBy(*keys, "share", "bucket").agg(F.sum("n").alias("n"))
        group = W.partitionBy(*keys, "share")
        merged = merged.withColumns(
            {"below": F.sum("n").over(group.orderBy("bucket")), "total": F.sum("n").over(group)}
        )
        # The lowest bucket that has a share q of the documents at or below it.
        quantile = [F.min(F.when(100 * F.col("below") >= q * F.col("total"), F.col("bucket"))) for q in (F.lit(50), tail)]
        found = merged.groupBy(*keys, "share").agg(F.max("total").alias("total"), quantile[0].alias("mid"), quantile[1].alias("high"))
        levels.append((level, keys, found))
    groups = sketches.select("lang", "source", "share").distinct()
    for level, keys, found in levels:
        cut = F.expr(f"high + (high - mid) div 2 + {TIE_GUARD}")
        names = [F.col(k).alias(f"_{k}") for k in (*keys, "share")]
        found = found.select(*names, cut.alias(f"cut{level}"), F.col("total").alias(f"n{level}"))
        match = F.col("share") == F.col("_share")
        for k in keys:
            match &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        groups = groups.join(found, match).drop("_share", *[f"_{k}" for k in keys])
    best = F.col("cut2")
    for level in (1, 0):
        own = F.least(F.col(f"cut{level}"), LIFT * best)
        best = F.when(F.col(f"n{level}") >= MIN_DOCUMENTS, own).otherwise(best)
    return groups.select("lang", "source", "share", best.alias("cutoff"))


def wide(cuts: DataFrame) -> DataFrame:
    """One row for each language and source, `_lang, _source, c_<share>`, stored so that its size is known."""
    out = cuts.groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).pivot("share", list(SHARES)).agg(F.max("cutoff"))
    return spool(out.select("_lang", "_source", *[F.col(k).alias(f"c_{k}") for k in SHARES]), "cutoffs")


def verdict(df: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds `kept` by joining rows with shares to the cutoffs of their group."""
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    within = ~F.col("base_failed")
    for k in SHARES:
        within &= F.col(f"s_{k}") <= F.coalesce(F.col(f"c_{k}"), F.lit(1000))
    return df.join(cuts, same, "left").withColumn("kept", within).drop("_lang", "_source", *[f"c_{k}" for k in SHARES])


def quality(df: DataFrame) -> DataFrame:
    """Counts, the fixed rules' result and the verdict of every document."""
    rows = spool(measured(df), "counts")
    judged = verdict(rows, wide(cutoffs(sketch(rows))))
    return judged.select("doc_id", *COUNTS[:5], "base_failed", "kept", *[f"s_{k}" for k in SHARES])


def good_documents(df: DataFrame) -> DataFrame:
    """The rows of `df` that are kept, with all their columns."""
    fields = ", ".join(f"{c}: long" for c in COUNTS)

    @F.pandas_udf(f"struct<{fields}>")
    def counts(texts):
        import pandas as pd

        return pd.DataFrame([counts_of(t) for t in texts], columns=COUNTS)

    # Or the optimizer would copy it below the filter and count twice, with a second Python worker for each task.
    counts = counts.asNondeterministic()
    cuts = wide(cutoffs(sketch(spool(measured(df), "counts"))))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    rows = df.select(row).withColumn("_counts", counts("_row.text"))
    rows = with_shares(rows.select("_row", "_counts.*", F.col("_row.lang").cast("string").alias("lang"), F.col("_row.source").cast("string").alias("source")))
    return verdict(rows, cuts).filter("kept").select("_row.*")
