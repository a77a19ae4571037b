"""Toxicity classification with a convolutional network over words.

A word's vector is the sum of hashed embeddings of the word, of its first four
and of its first five letters. Filters of one, two and three words with
rectifiers are pooled by their maximum over the whole text, and a logistic layer
gives the score. All labelled documents that are not held out are dealt by id into
shards of about SHARD. The network starts on the first shard; then each shard's
task goes over its documents from the same network, and the changes are averaged,
those of a word's embedding over the shards that have it.

The score is shifted so that 0.5 is the calibrated threshold of the language the
text itself points to, by word counts of all labelled documents; a quarter of
them, not trained on, sets the thresholds, from counts by language and logit in
steps of 1 / STEPS. Null and empty texts get the score of a text without words.
Without labels of both kinds, every score is the share of label 1, or 0. Rows
with a null id are scored and never learnt from; repeated rows are scored each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from plumbline.llm.frames import map_rows

# Labelled documents of a shard, which one task holds as word buckets.
SHARD = 6000
STEPS = 1024
# Numbers added up at once, and tasks that do so; keys of the network's sums, others are languages.
BLOCK, SUM_TASKS = 16_384, 64
NET, PAST = -1, -2
BUCKETS = 1 << 15
WIDTH = 16
FILTERS = 12
SPANS = (1, 2, 3)
EPOCHS = 6
# Small samples are gone over more often, until so many documents have been seen.
LEAST_SEEN = 20_000
BATCH = 50
RATE = 0.1
# Words whose vectors a task keeps before it starts over.
CACHE_WORDS = 250_000
_EDGES = ".,;:!?\"'()[]{}*#$%&|<>-_=/"


def hashed(word: str) -> tuple[int, int, int]:
    """Buckets of a word in lower case and of its beginnings; bucket 0 is left for padding."""
    word = word.strip(_EDGES)
    keys = (word, "4 " + word[:4], "5 " + word[:5])
    return tuple(1 + zlib.crc32(k.encode("utf-8", "replace")) % (BUCKETS - 1) for k in keys)


# Examples of either label without which none are kept aside; a language with fewer aside takes the threshold of all.
ASIDE_LEAST = 8


class Network:
    def __init__(self, seed: int = 11) -> None:
        rnd = np.random.default_rng(seed)
        self.embed = rnd.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
        self.embed[0] = 0
        self.filters = [rnd.normal(0, 0.3 / s**0.5, (s * WIDTH, FILTERS)).astype(np.float32) for s in SPANS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in SPANS]
        self.out = rnd.normal(0, 0.1, FILTERS * len(SPANS)).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    def pooled(self, vectors: np.ndarray, starts: np.ndarray):
        """Pooled activations of texts laid end to end, each followed by padding rows; and the windows they came from."""
        values, places = [], []
        ends = np.append(starts[1:], len(vectors))
        longer = np.concatenate([vectors, np.zeros((max(SPANS), vectors.shape[1]), vectors.dtype)])
        for span, f, b in zip(SPANS, self.filters, self.bias):
            act = b + sum(longer[k : k + len(vectors)] @ f[k * WIDTH : (k + 1) * WIDTH] for k in range(span))
            # Windows that reach beyond a text's padding would see the next text.
            for k in range(1, span):
                act[ends - k] = -np.inf
            top = np.maximum.reduceat(act, starts)
            values.append(top)
            places.append((act, ends))
        return np.concatenate(values, axis=1), places

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, *self.bias, self.out, self.base]

    @classmethod
    def of(cls, parameters: list[np.ndarray]) -> Network:
        net = cls()
        for q, p in zip(net.parameters(), parameters):
            q[...] = p
        return net

    def logits(self, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.maximum(self.pooled(vectors, starts)[0], 0) @ self.out + self.base


def lay_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word rows of all texts with padding after each, and where each text starts."""
    pad = max(SPANS)
    lengths = np.array([len(t) + pad for t in texts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    rows = np.zeros((int(lengths.sum()), *texts[0].shape[1:]), texts[0].dtype)
    for t, s in zip(texts, starts):
        rows[s : s + len(t)] = t
    return rows, starts


def gradients(net: Network, ids: np.ndarray, starts: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Slopes of the weighted logistic loss of a batch in every parameter; the padding's vector stays."""
    vectors = net.embed[ids[:, 0]] + net.embed[ids[:, 1]] + net.embed[ids[:, 2]]
    values, places = net.pooled(vectors, starts)
    active = np.maximum(values, 0)
    p = 1 / (1 + np.exp(-np.clip(active @ net.out + net.base, -30, 30)))
    error = (weight * (p - labels) / len(labels)).astype(net.out.dtype)
    to_pool = np.where(values > 0, error[:, None] * net.out, 0)
    grads = [np.zeros_like(q) for q in net.parameters()]
    grads[-2], grads[-1] = active.T @ error, error.sum(keepdims=True)
    for n, (span, (act, ends)) in enumerate(zip(SPANS, places)):
        g = to_pool[:, n * FILTERS : (n + 1) * FILTERS]
        where = np.array([s + act[s:e].argmax(axis=0) for s, e in zip(starts, ends)])
        doc, filt = np.nonzero(g)
        place, g = where[doc, filt], g[doc, filt][:, None]
        np.add.at(grads[1 + len(SPANS) + n], filt, g[:, 0])
        for k in range(span):
            part = slice(k * WIDTH, (k + 1) * WIDTH)
            to_filter = np.zeros((FILTERS, WIDTH), net.out.dtype)
            np.add.at(to_filter, filt, g * vectors[place + k])
            grads[1 + n][part] += to_filter.T
            to_word = g * net.filters[n][part, filt].T
            for column in range(3):
                np.add.at(grads[0], ids[place + k, column], to_word)
    grads[0][0] = 0
    return grads


def train(net: Network, past: list[np.ndarray], texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rounds: int, seed: int = 11) -> None:
    """Adagrad on the logistic loss, in place; gradients flow through the pooled windows only."""
    rnd = np.random.default_rng(seed)
    params = net.parameters()
    for _ in range(rounds):
        order = rnd.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            grads = gradients(net, *lay_out([texts[i] for i in chosen]), labels[chosen], weight[chosen])
            for q, g, h in zip(params, grads, past):
                h += g * g
                q -= RATE * g / np.sqrt(h)


class Scorer:
    """The network, the word counts of each language and the threshold of each language."""

    def __init__(self, net: Network, tongues: np.ndarray, thresholds: np.ndarray) -> None:
        self.net, self.tongues, self.thresholds = net, tongues, thresholds

    def shifted(self, logits: np.ndarray, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits - self.thresholds[evidence.argmax(axis=1)], -30, 30)))


class WordVectors:
    """Vectors of the words met so far, with the evidence for each language beside them."""

    def __init__(self, scorer: Scorer) -> None:
        self.scorer, self.known = scorer, {}
        self.rows = np.zeros((1 << 12, WIDTH + scorer.tongues.shape[1]), np.float32)

    def of(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [(t or "").lower().split() for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list(set().union(*split).difference(self.known))
        if new:
            ids = np.array(list(map(hashed, new)))
            embed = self.scorer.net.embed
            made = np.concatenate([embed[ids[:, 0]] + embed[ids[:, 1]] + embed[ids[:, 2]], self.scorer.tongues[ids[:, 0]]], axis=1)
            first = len(self.known) + 1
            while first + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[first : first + len(new)] = made
            self.known.update(zip(new, range(first, first + len(new))))
        get = self.known.__getitem__
        return [np.fromiter(map(get, ws), np.int64, len(ws)) for ws in split]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        places, starts = lay_out(self.of(texts))
        rows = self.rows[places]
        evidence = np.add.reduceat(rows[:, WIDTH:], starts)
        return self.scorer.shifted(self.scorer.net.logits(rows[:, :WIDTH], starts), evidence)


class Hasher:
    """Word buckets of texts; words are hashed once each."""

    def __init__(self) -> None:
        self.known: dict[str, tuple] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        self.known.update((w, hashed(w)) for w in set(words).difference(self.known))
        # BUCKETS fit into 16 bits with the sign.
        return np.fromiter(chain.from_iterable(map(self.known.__getitem__, words)), np.int16).reshape(-1, 3)


def shard_of(rows: Iterator[Row], few: bool, alone: bool) -> list[tuple[np.ndarray, int, str | None, bool, bool]]:
    """Word buckets, label, language, whether to learn from and whether to set thresholds by, in a fixed order.

    Every fourth document is kept aside to set the thresholds; where a label is rare, all train and set them.
    """
    buckets = Hasher()
    found = [(r.h, r.doc_id, buckets(r.text), r) for r in rows]
    found.sort(key=lambda f: (f[0], f[1], f[2].size, f[2].tobytes(), f[3].lang or ""))
    aside = [n % 4 == 3 for n in range(len(found))]
    if alone:
        few = few or any(len({r.toxic for (*_, r), a in zip(found, aside) if a == kept}) < 2 for kept in (True, False))
    return [(words, r.toxic, r.lang, few or not a, few or a) for (_, _, words, r), a in zip(found, aside)]


def word_counts(shard: list[tuple]) -> dict[str, np.ndarray]:
    """Words by bucket for each language."""
    counts: dict[str, np.ndarray] = {}
    for words, _, lang, _, _ in shard:
        if lang is not None:
            counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
            np.add.at(counts[lang], words[:, 0], 1)
    return counts


def trained(shard: list[tuple], net: Network, past: list[np.ndarray], share: float | None, rounds: int, least: int = 0) -> None:
    """Goes over a shard's documents to learn from; both labels weigh the same where `share` have label 1, the shard's own if None."""
    learning = [e for e in shard if e[3]]
    if learning:
        labels = np.array([e[1] for e in learning], np.float32)
        share = labels.mean() if share is None else share
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        train(net, past, [e[0] for e in learning], labels, weight, max(rounds, -(-least // len(learning))))


def flat(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays])


def unflat(vector: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    cuts = np.cumsum([a.size for a in like])
    return [v.reshape(a.shape) for v, a in zip(np.split(vector, cuts[:-1]), like)]


def summed(vectors: RDD) -> dict:
    """Sums of `(key, vector)` by key; added up in blocks, so that no task holds many vectors."""
    blocks = vectors.flatMap(lambda kv: [((kv[0], at), kv[1][at : at + BLOCK]) for at in range(0, len(kv[1]), BLOCK)])
    found: dict = {}
    for (key, _), block in sorted(blocks.reduceByKey(np.add, SUM_TASKS).collect(), key=lambda b: b[0]):
        found.setdefault(key, []).append(block)
    return {key: np.concatenate(parts) for key, parts in found.items()}


def network_and_counts(rows: RDD, names: list[str], share: float, few: bool, total: int) -> tuple[Network, dict[int, np.ndarray]]:
    """The network after rounds over all shards, and the words of all labelled documents by language and bucket."""
    many = rows.getNumPartitions()
    alone = many == 1

    def counted(shard):
        return [(names.index(lang), n) for lang, n in word_counts(shard).items()]

    def first(number, part):
        if number:
            return []
        shard, net = shard_of(part, few, alone), Network()
        past = [np.full_like(p, 1e-4) for p in net.parameters()]
        trained(shard, net, past, None if alone else share, EPOCHS, LEAST_SEEN)
        return [(NET, flat(net.parameters())), (PAST, flat(past)), *(counted(shard) if alone else [])]

    found = summed(rows.mapPartitionsWithIndex(first))
    start = unflat(found[NET], Network().parameters())
    past = unflat(found[PAST], start)
    counts = found
    for turn in range(0 if alone else -(-LEAST_SEEN // total)):
        sent = rows.context.broadcast((start, past))

        def each(part, turn=turn, sent=sent):
            shard = shard_of(part, few, alone)
            if not shard:
                return []
            start, before = sent.value
            # Broadcast values are shared by the tasks of a worker.
            net, past = Network.of(start), [p.copy() for p in before]
            trained(shard, net, past, share, 1)
            met = (past[0] != before[0]).any(axis=1).astype(np.float32)
            change = [q - p for q, p in zip(net.parameters(), start)]
            return [(NET, flat([*change, met, np.ones(1, np.float32)])), *([] if turn else counted(shard))]

        found = summed(rows.mapPartitions(each))
        counts = counts if turn else found
        *changes, met, shards = unflat(found[NET], [*start, start[0][:, 0], np.ones(1)])
        over = [np.maximum(met, 1)[:, None]] + [shards] * (len(start) - 1)
        start = [p + change / n for p, change, n in zip(start, changes, over)]
    return Network.of(start), counts


def fit(examples: DataFrame) -> Scorer | float:
    """Scorer learned from all `examples`; the share of label 1 if all labels are alike."""
    groups = examples.groupBy("lang", "toxic").count().collect()
    total, toxic = sum(r["count"] for r in groups), sum(r["count"] for r in groups if r.toxic == 1)
    if toxic in (0, total):
        return toxic / total if total else 0.0
    names = sorted({r.lang for r in groups if r.lang is not None}) or [""]
    rows = examples.rdd
    alone = rows.getNumPartitions() == 1
    # Over several shards both labels have to be among those aside in any deal.
    few = min(toxic, total - toxic) < ASIDE_LEAST * (1 if alone else 4)
    net, found = network_and_counts(rows, names, toxic / total, few, total)
    counts = np.full((BUCKETS, len(names)), 0.1)
    for n in range(len(names)):
        counts[:, n] += found.get(n, 0)
    counts[0] = 1
    tongues = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    tongues -= tongues.mean(axis=1, keepdims=True)
    tongues[0] = 0
    sent = rows.context.broadcast((net, tongues))

    def logits(part):
        net, tongues = sent.value
        shard = [e for e in shard_of(part, few, alone) if e[4]]
        met: dict[tuple[int, int], list[int]] = {}
        for at in range(0, len(shard), BATCH):
            ids, starts = lay_out([e[0] for e in shard[at : at + BATCH]])
            vectors = net.embed[ids[:, 0]] + net.embed[ids[:, 1]] + net.embed[ids[:, 2]]
            steps = np.floor(np.clip(net.logits(vectors, starts), -30, 30) * STEPS).astype(int)
            tongue = np.add.reduceat(tongues[ids[:, 0]], starts).argmax(axis=1)
            for key, e in zip(zip(tongue.tolist(), steps.tolist()), shard[at : at + BATCH]):
                n = met.setdefault(key, [0, 0])
                n[0] += e[1]
                n[1] += 1
        return list(met.items())

    # At most 60 * STEPS rows a language.
    binned = rows.mapPartitions(logits).reduceByKey(lambda a, b: [a[0] + b[0], a[1] + b[1]]).collect()

    def cut(tongue: int | None) -> float | None:
        of: dict[int, np.ndarray] = {}
        for (t, step), n in binned:
            if tongue in (None, t):
                of[step] = of.get(step, 0) + np.array(n)
        ones, many = np.array([of[s] for s in sorted(of)]).reshape(-1, 2).T
        if tongue is not None and min(ones.sum(), (many - ones).sum()) < ASIDE_LEAST:
            return None
        return threshold((np.array(sorted(of)) + 0.5) / STEPS, ones, many)

    overall = cut(None)
    own = [cut(n) for n in range(len(names))]
    return Scorer(net, tongues, np.array([overall if c is None else c for c in own]))


def threshold(logits: np.ndarray, labels: np.ndarray, many: np.ndarray | int = 1) -> float:
    """Middle of the gap between logits with the fewest errors, the widest such gap of equal ones.

    A logit may stand for `many` documents, of which `labels` have label 1.
    """
    order = np.argsort(logits)
    x, y, others = logits[order], labels[order], (many - labels)[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum(others[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], (x[1:] + x[:-1]) / 2, [x[-1] + 1]])
    gaps = np.concatenate([[0], np.diff(x), [0]])
    return float(edges[max(range(len(edges)), key=lambda i: (-errors[i], gaps[i]))])


def examples(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, text, lang, toxic, h` of all labelled documents that are not held out, a partition for each shard."""
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    shards = max(1, -(-known.count() // SHARD))
    # With fewer partitions than usual the join would deal the texts out again.
    parts = max(shards, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = documents.select("doc_id", "text", "lang").filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    # A broadcast of either side would keep the other's partitions.
    found = rows.repartition(parts, "doc_id").join(known.repartition(parts, "doc_id").hint("merge"), "doc_id").coalesce(shards)
    return found.withColumn("h", F.xxhash64("doc_id"))


def score(df: DataFrame, scorer: Scorer | float) -> DataFrame:
    """`doc_id, held_out, score, predicted` of every row."""
    sent = df.sparkSession.sparkContext.broadcast(scorer)

    def make():
        vectors = WordVectors(sent.value) if isinstance(sent.value, Scorer) else None

        def run(batch):
            found = vectors.scores(batch["text"]).tolist() if vectors else [sent.value] * len(batch["text"])
            return {
                "doc_id": batch["doc_id"],
                "held_out": batch["held_out"],
                "score": found,
                "predicted": [int(s >= 0.5) for s in found],
            }

        return run

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    return map_rows(rows, make, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Trains on the labelled documents that are not held out and scores all."""
    return score(documents, fit(examples(documents, labels)))
