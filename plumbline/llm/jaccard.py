"""Exact Jaccard join of documents' shingle sets, size-aware and heavy-light.

A document's identity in the join is the fingerprint of its shingle set, so equal
sets are one from the start. Two sets link at a Jaccard similarity of THRESHOLD
percent or more; the result is the components of the links.

1. Shingles that fill more than a 100,000th of all occurrences are heavy. They
   are counted in each task, added up, and known to every task from then on.
   They stay with their set. The light ones go out by hash, in packed rows,
   and come back if more than one set has them.
2. All shingles are ordered by rarity. If two sets link, they share a shingle of
   the first n - ceil(0.8 n) + 1 of each; where these are in no other set, the
   set has no link and leaves the join.
3. Sets up to a boundary size enumerate the pairs of shingles of a prefix longer
   by one, and meet where they share a pair; larger sets are met by scanning
   inverted lists, which hold all sets, shingle by shingle. The boundary is the one at
   which the counted cost of both together is least.
4. Within a list a set is first compared with a few hubs, and the closest are
   verified: that joins nearly all that belongs together at a cost linear in the
   list. After that, only members outside a list's main component are compared
   with the others, by parity bitmaps whose distance can't exceed that of
   the sets; what passes is verified on the whole sets.

Documents with fewer words than a shingle are their whole sequence; those without
words or with null text are empty and link with nothing. Repeated rows get a row
each; rows with a null id take the smallest id they are linked with, if any.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.frames import arrow_schema, map_rows
from plumbline.operators.components import connected_components
from plumbline.session import spool

WORDS = 5
THRESHOLD = 80
# Heavy shingles hold more than this share of all occurrences, and at least so many.
HEAVY_SHARE, HEAVY_LEAST = 100_000, 1000
BUCKET_CHARACTERS = 24_000_000
BITMAP_LONGS = 8
HUBS = 3
VERIFIED_HUBS = 2
CACHE_WORDS = 400_000
# Parts in which a bucket's hashes are sorted, one after the other; divides 256.
SLICES = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)


class Shingler:
    """Distinct shingle hashes of texts; words are hashed once each."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted 64-bit hashes."""
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(WORDS, len(codes))
        n = len(codes) - size + 1
        h = np.full(n, size, np.uint64)
        for k in range(size):
            h = h * _MIX + codes[k : k + n]
            h ^= h >> np.uint64(29)
        h *= _FINAL
        h ^= h >> np.uint64(32)
        return np.unique(h)


def fingerprint(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def needed(n: Column) -> Column:
    """Length of the prefix in which a linked set must share a shingle."""
    return n - F.ceil(n * THRESHOLD / 100.0).cast("long") + 1


def row_key(df: DataFrame) -> Column:
    """Hash of a row's id and text, never null; rows equal in both share it."""
    text = F.coalesce(F.concat(F.lit("="), df["text"]), F.lit(""))
    return F.unhex(F.md5(F.concat(F.coalesce(df["doc_id"].cast("long").cast("string"), F.lit("")), text)))


def sizes(df: DataFrame) -> DataFrame:
    """`doc_id, row, n, sig` of every row, and for each batch the shingles often met in it: `doc_id` null, `hot` set."""

    def make():
        shingle = Shingler()

        def run(batch):
            sets = [shingle(t) for t in batch["text"]]
            every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            found, times = np.unique(every, return_counts=True)
            often = times >= max(3, len(every) // HEAVY_SHARE)
            out = {
                "doc_id": batch["doc_id"],
                "row": batch["row"],
                "n": [len(s) for s in sets],
                "sig": [fingerprint(s) if len(s) else None for s in sets],
                "hot": [None] * len(sets),
            }
            for h, t in zip(found[often].view(np.int64).tolist(), times[often].tolist()):
                for k, v in zip(out, (None, None, t, None, h)):
                    out[k].append(v)
            return out

        return run

    columns = [F.col("doc_id").cast("long").alias("doc_id"), row_key(df).alias("row"), "text"]
    return map_rows(df.select(*columns), make, "doc_id long, row binary, n long, sig binary, hot long")


def packed_shingles(df: DataFrame, heavy: np.ndarray, buckets: int) -> DataFrame:
    """For each set and bucket `bucket, sig, n, hashes`; heavy shingles are in buckets below 0."""
    sent = df.sparkSession.sparkContext.broadcast(np.sort(heavy))

    def make():
        shingle, hot = Shingler(), sent.value

        def run(batch):
            out = {"bucket": [], "sig": [], "n": [], "hashes": []}
            rows: dict[int, list] = {}
            seen = set()
            for text in batch["text"]:
                hashes = shingle(text)
                sig = fingerprint(hashes)
                if not len(hashes) or sig in seen:
                    continue
                seen.add(sig)
                at = np.minimum(np.searchsorted(hot, hashes), max(len(hot) - 1, 0))
                is_hot = hot[at] == hashes if len(hot) else np.zeros(len(hashes), bool)
                light = hashes[~is_hot]
                place = ((light >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                # The hashes are sorted, and so are their buckets.
                cuts = np.flatnonzero(np.diff(place)) + 1
                for b, part in zip(place[np.concatenate([[0], cuts])].tolist() if len(light) else [], np.split(light, cuts)):
                    rows.setdefault(b, []).append((sig, len(part), part))
                rows.setdefault(-1 - int.from_bytes(sig[:4]) % buckets, []).append((sig, len(hashes), hashes[is_hot]))
            for b, parts in rows.items():
                if b < 0:
                    for sig, n, part in parts:
                        for k, v in zip(out, (b, sig, n, part.tobytes())):
                            out[k].append(v)
                else:
                    # One row for each bucket and batch: signatures, counts and hashes laid end to end.
                    packed = b"".join(s for s, _, _ in parts) + np.array([n for _, n, _ in parts], np.uint32).tobytes()
                    for k, v in zip(out, (b, packed, len(parts), np.concatenate([p for _, _, p in parts]).tobytes())):
                        out[k].append(v)
            return out

        return run

    return map_rows(df.select("text"), make, "bucket int, sig binary, n long, hashes binary")


def _numbered(sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 16-byte signatures, and the number of each entry's."""
    halves = sigs.view(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (halves[order[1:]] != halves[order[:-1]]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return sigs[order[new]], which


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes that more than one owner has, their owners and how many there are; an owner's repeats count once."""
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
    times = np.diff(np.append(starts, len(hashes))).astype(np.uint32)
    df = np.repeat(times, times)
    keep = df > 1
    return hashes[keep], owner[keep], df[keep]


def _packed_binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends * values.itemsize]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def shared_in_bucket(table: pa.Table, out: pa.Schema) -> pa.Table:
    """Shingles of one bucket in more than one set, a row for each set; in little more memory than the hashes take."""
    # Views on what Arrow holds; only the hashes and the number of each one's set are laid end to end.
    packed, blobs = ([v.as_buffer() for chunk in table.column(c).chunks for v in chunk] for c in ("sig", "hashes"))
    many = table.column("n").to_pylist()
    sigs = np.concatenate([np.frombuffer(s, "V16", n) for s, n in zip(packed, many)])
    counts = np.concatenate([np.frombuffer(s, np.uint32, n, 16 * n) for s, n in zip(packed, many)])
    names, which = _numbered(sigs)
    owner = np.repeat(which.astype(np.uint32), counts)
    hashes = np.concatenate([np.frombuffer(h, np.uint64) for h in blobs])
    # By the lowest byte of the hash, so that what is sorted at once stays small.
    part = hashes.view(np.uint8)[::8] % SLICES if sys.byteorder == "little" else (hashes % SLICES).astype(np.uint8)
    kept = [_repeated(hashes[at], owner[at]) for at in (np.flatnonzero(part == s) for s in range(SLICES))]
    del hashes, owner, part
    hashes, owner, df = (np.concatenate(k) for k in zip(*kept))
    del kept
    order = np.argsort(owner, kind="stable")
    owner = owner[order]
    last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True)[: len(owner)])
    ends = last + 1
    columns = [
        _packed_binary(names[owner[last]], np.arange(1, len(last) + 1)),
        pa.array(np.zeros(len(last), np.int64)),
        _packed_binary(hashes[order], ends),
        _packed_binary(df[order].astype(np.int64), ends),
    ]
    return pa.table(columns, schema=out)


def shared_shingles(packed: DataFrame, buckets: int) -> DataFrame:
    """`sig, n, hashes, df`: light shingles in more than one set, and for each set a row of its heavy ones with `n`."""
    schema = "sig binary, n long, hashes binary, df binary"
    out = arrow_schema(schema)

    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() >= 0:
            return shared_in_bucket(table, out)
        rows = zip(*(table.column(c).to_pylist() for c in ("sig", "n", "hashes")))
        found = [(sig, n, h, None) for sig, (n, h) in {sig: (n, h) for sig, n, h in rows}.items()]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    # As many partitions as buckets, so that what a task gathers stays the same at every size.
    return packed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(run, schema)


def records(parts: DataFrame, heavy: DataFrame) -> DataFrame:
    """`sig, n, unique, tokens, bits`: shared shingles of each set, the rarest first, and their parity bitmap.

    Parts of a set are put together; a set's own size bounds what is collected.
    Sets that can't link are left out.
    """
    grouped = parts.groupBy("sig").agg(F.max("n").alias("n"), F.collect_list(F.struct("hashes", "df")).alias("parts"))
    sent = parts.sparkSession.sparkContext.broadcast({r["hot"]: r["n"] for r in heavy.collect()})

    def make():
        hot = sent.value

        def run(batch):
            out = {"sig": batch["sig"], "n": batch["n"], "unique": [], "tokens": [], "bits": []}
            for n, parts in zip(batch["n"], batch["parts"]):
                rows = {}
                for p in parts:
                    hashes = np.frombuffer(p["hashes"], np.int64).tolist()
                    times = [hot[h] for h in hashes] if p["df"] is None else np.frombuffer(p["df"], np.int64).tolist()
                    rows.update(zip(hashes, times))
                tokens = [h for h, _ in sorted(rows.items(), key=lambda r: (r[1], r[0]))]
                bits = np.bincount(np.array(tokens, np.int64) & (64 * BITMAP_LONGS - 1), minlength=64 * BITMAP_LONGS)
                out["tokens"].append(tokens)
                out["unique"].append(n - len(tokens))
                out["bits"].append(np.packbits((bits & 1).astype(np.uint8)).view(np.int64).tolist())
            return out

        return run

    made = map_rows(grouped, make, "sig binary, n long, unique long, tokens array<long>, bits array<long>")
    return made.filter(needed(F.col("n")) > F.col("unique"))


def _distance(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _may_link(a_n, b_n, a_unique, b_unique, distance) -> Column:
    """Linked sets differ in at most (n + m) / 9 shingles; those in no other set differ for sure."""
    share = F.lit(100 - THRESHOLD) * (F.col(a_n) + F.col(b_n))
    differ = F.col(a_unique) + F.col(b_unique) + distance
    small = F.least(a_n, b_n) * 100 >= F.greatest(a_n, b_n) * THRESHOLD
    return small & (differ * (100 + THRESHOLD) <= share)


def boundary(sets: DataFrame) -> int:
    """Size up to which enumerating pairs costs less than scanning lists, from counts by size."""
    kept = F.least(needed(F.col("n")) - F.col("unique") + 1, F.size("tokens").cast("long"))
    by_size = sets.groupBy("n").agg(F.sum(kept * (kept - 1) / 2).alias("pairs"), F.sum(kept).alias("scans"), F.count("*").alias("sets"))
    # A scanned entry meets every set of similar size on its list; its cost is taken as twice that of a pair's row.
    total = W.orderBy("n")
    up_to = by_size.withColumns({"enumerated": F.sum("pairs").over(total), "scanned": 2 * F.sum("scans").over(total)})
    best = up_to.agg(F.max_by("n", F.col("scanned") - F.col("enumerated")), F.max(F.col("scanned") - F.col("enumerated"))).first()
    return int(best[0]) if best[0] is not None and best[1] > 0 else 0


def lists(sets: DataFrame, limit: int) -> DataFrame:
    """`key, sig, n, unique, bits, large`: entries of the lists on which linked sets must meet.

    Two sets of at most `limit` shingles that link share two shingles of their
    prefixes longer by one, or have too few for that and share one. Any other two meet on single shingles.
    """
    # The size of the larger set decides whether a pair meets by pairs, so sets near the boundary enter both ways.
    prefix = (needed(F.col("n")) - F.col("unique")).cast("int")
    tokens = sets.withColumn("prefix", prefix)
    small = F.col("n") <= limit
    # Sets that a larger one than `limit` can link with.
    beside = F.col("n") * 100 >= THRESHOLD * F.lit(limit + 1)
    few = F.ceil(F.col("n") * THRESHOLD / 100.0) < 2
    single = F.transform(F.slice("tokens", 1, F.col("prefix")), lambda t: F.xxhash64(t))
    longer = F.slice("tokens", 1, F.col("prefix") + 1)
    double = F.flatten(
        F.transform(longer, lambda t, i: F.transform(F.slice(longer, i + 2, F.greatest(F.size(longer) - i - 1, F.lit(0))), lambda u: F.xxhash64(t, u)))
    )
    cols = ["sig", "n", "unique", "bits"]
    scan = tokens.filter(~small | beside | few).select(F.explode(single).alias("key"), *cols, F.lit(False).alias("pair"))
    enum = tokens.filter(small & ~few).select(F.explode(double).alias("key"), *cols, F.lit(True).alias("pair"))
    return scan.union(enum)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`src, dst` of the pairs that link, by their whole shared shingles."""
    one = sets.select(F.col("sig").alias("src"), F.col("n").alias("_n"), F.col("tokens").alias("_t"))
    two = sets.select(F.col("sig").alias("dst"), F.col("n").alias("_m"), F.col("tokens").alias("_u"))
    both = pairs.join(one, "src").join(two, "dst")
    common = F.size(F.array_intersect("_t", "_u"))
    linked = both.withColumn("_c", common).filter(F.col("_c") * 100 >= THRESHOLD * (F.col("_n") + F.col("_m") - F.col("_c")))
    return linked.select("src", "dst")


def hub_pairs(entries: DataFrame) -> DataFrame:
    """For each set its closest hubs that may link."""
    hubs = []
    for salt in range(HUBS):
        order = F.xxhash64(F.lit(f"hub {salt}"), F.col("key"), F.col("sig"))
        hubs.append(F.min_by(F.struct(F.col("sig").alias("h"), F.col("n").alias("h_n"), F.col("unique").alias("h_u"), F.col("bits").alias("h_bits")), order).alias(f"h{salt}"))
    chosen = entries.groupBy("key", "pair").agg(*hubs, F.count("*").alias("many")).filter("many > 1")
    chosen = chosen.select("key", "pair", F.explode(F.array(*[f"h{s}" for s in range(HUBS)])).alias("hub")).select("key", "pair", "hub.*")
    near = entries.join(chosen, ["key", "pair"]).filter("sig != h")
    near = near.withColumn("d", _distance("bits", "h_bits") + F.col("unique") + F.col("h_u"))
    near = near.filter(_may_link("n", "h_n", "unique", "h_u", F.col("d") - F.col("unique") - F.col("h_u")))
    score = F.col("d") / (F.col("n") + F.col("h_n"))
    best = near.groupBy("sig").agg(F.slice(F.array_sort(F.collect_set(F.struct(score.alias("s"), F.col("h")))), 1, VERIFIED_HUBS).alias("best"))
    pair = best.select(F.col("sig").alias("a"), F.explode("best.h").alias("b"))
    return pair.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()


def cross_pairs(entries: DataFrame, component: DataFrame) -> DataFrame:
    """Pairs of different components that may link and meet on a list."""
    placed = spool(entries.join(component.withColumnRenamed("node", "sig"), "sig"), "placed")
    by = placed.groupBy("key", "pair", "component").agg(F.count("*").alias("n"))
    main = by.groupBy("key", "pair").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    main = spool(main.filter("parts > 1").select("key", "pair", "main"), "main")
    members = placed.join(main, ["key", "pair"])
    probes = members.filter("component != main").select(
        "key", "pair", *[F.col(c).alias(f"p_{c}") for c in ("sig", "n", "unique", "bits", "component")]
    )
    met = probes.join(members, ["key", "pair"]).filter("component != p_component AND (sig > p_sig OR component = main)")
    met = met.filter(_may_link("n", "p_n", "unique", "p_unique", _distance("bits", "p_bits")))
    return met.select(F.least("sig", "p_sig").alias("src"), F.greatest("sig", "p_sig").alias("dst")).distinct()


def links_and_components(sets: DataFrame) -> DataFrame:
    """`node, component` of the sets that have a link."""
    entries = spool(lists(sets, boundary(sets)), "lists")
    # A key with one entry, of either kind, joins nothing.
    nodes = sets.select(F.col("sig").alias("node"))
    first = spool(verified(hub_pairs(entries), sets), "links")
    component = spool(connected_components(nodes, first), "components")
    more = spool(verified(cross_pairs(entries, component), sets), "links")
    of = lambda end: component.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
    bridges = more.join(of("src"), "src").join(of("dst"), "dst").select(F.col("c_src").alias("src"), F.col("c_dst").alias("dst"))
    joined = connected_components(component.select(F.col("component").alias("node")).distinct(), bridges)
    joined = joined.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    return component.join(joined, "component").select("node", F.col("joined").alias("component"))


def placed_rows(df: DataFrame) -> DataFrame:
    """`doc_id, row, n, sig, component` of every row; without words the component is null."""
    measured = spool(sizes(df), "sizes")
    docs = measured.filter("hot IS NULL")
    total = docs.agg(F.sum("n")).first()[0] or 0
    limit = max(HEAVY_LEAST, total // HEAVY_SHARE)
    # At most a few times HEAVY_SHARE rows: each stands for a share of all occurrences.
    heavy = measured.filter("hot IS NOT NULL").groupBy("hot").agg(F.sum("n").alias("n")).filter(F.col("n") >= limit)
    heavy = spool(heavy, "heavy")
    hot = np.array([r["hot"] for r in heavy.select("hot").collect()], np.int64).view(np.uint64)
    characters = df.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(8, -(-characters // BUCKET_CHARACTERS))
    packed = packed_shingles(df, hot, buckets)
    sets = spool(records(shared_shingles(packed, buckets), heavy), "sets")
    component = links_and_components(sets)
    placed = docs.join(component.withColumnRenamed("node", "sig"), "sig", "left")
    return spool(placed.withColumn("component", F.coalesce("component", "sig")).drop("hot"), "placed")


def jaccard_components(df: DataFrame) -> DataFrame:
    """`doc_id, n_shingles, component_id` of every row."""
    placed = placed_rows(df)
    least = placed.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(least, "component", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def representatives(df: DataFrame) -> DataFrame:
    """The row with the smallest id of each component, rows without an id last, with all columns of `df`.

    Rows equal in id and text are one document. Rows without words are a component
    each, or all those of one id with the same text; without an id, all stay.
    """
    placed = placed_rows(df)
    worded = F.col("component").isNotNull()
    # Rows of one key have one text, so they lie in one component.
    keys = placed.filter(worded | F.col("doc_id").isNotNull()).groupBy("row", "doc_id", "component").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "n")
    least = keys.filter(worded).groupBy("component").agg(F.min(order).alias("first")).select("first.row", "first.n")
    loose = placed.filter(~worded & F.col("doc_id").isNull()).select("row", F.lit(1).cast("long").alias("n")).distinct()
    kept = spool(least.union(keys.filter(~worded).select("row", "n")).union(loose), "kept")
    # The row travels as one column, so that none of its names can clash.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), row_key(df).alias("_key"))
    once, often = (kept.filter(c).select(F.col("row").alias("_key")) for c in ("n = 1", "n > 1"))
    out = rows.join(once, "_key", "left_semi")
    if not often.isEmpty():
        out = out.unionByName(rows.join(often, "_key", "left_semi").dropDuplicates(["_key"]))
    return out.select("_row.*")
