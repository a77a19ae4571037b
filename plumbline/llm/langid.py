"""Language identification with string kernels.

The kernel is the blended spectrum of presence: for n = 1..4, the number of byte
n-grams two texts share over the geometric mean of how many they have, averaged
over n. n-grams of three and four bytes are hashed to 18 bits, and the feature
space holds those that the landmarks have. Nyström features come from landmark
documents, and one-versus-rest ridge regression is fitted on them. Both steps
are linear in a document's presence vector, so they are multiplied out once and
documents are scored by one matrix product for each batch.

The model is fitted on at most TRAIN_DOCUMENTS labelled documents, the same
number for each language, chosen by a hash of their id; a quarter of them, at
most LANDMARKS, are landmarks. Every whole text is scored. Null text and text
without a letter give `und`; so does everything if nothing is labelled. Rows
with a null id are scored, and never learnt from. Repeated rows are scored each.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.llm.frames import map_rows

TRAIN_DOCUMENTS = 1600
LANDMARKS = 400
HASH_BITS = 18
RIDGE = 0.1
LETTER = regex.compile(r"\p{L}")
# Where the codes of each n start.
STARTS = np.cumsum([0, 1 << 8, 1 << 16, 1 << HASH_BITS, 1 << HASH_BITS])
UNKNOWN = "und"


def gram_codes(text: str) -> list[np.ndarray]:
    """Codes of the byte n-grams of a text in lower case, one array for each n; with repeats."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    codes = [data]
    for n in (1, 2, 3):
        codes.append((codes[-1][:-1] << np.uint32(8)) | data[n:] if len(data) > n else data[:0])
    shift, odd = np.uint32(32 - HASH_BITS), np.uint32(2654435761)
    hashed = [codes[0], codes[1], *((c * odd) >> shift for c in codes[2:])]
    return [h.astype(np.int64) + s for h, s in zip(hashed, STARTS)]


class Model:
    """Presence weights of each language."""

    def __init__(self, languages: list[str], features: np.ndarray, weights: np.ndarray) -> None:
        self.languages, self.features = languages, features
        self.column = np.full(STARTS[-1], len(features), np.int64)
        self.column[features] = np.arange(len(features))
        # The features are in the order of n.
        self.blocks = np.searchsorted(features, STARTS)
        self.weights = weights.astype(np.float32)

    def presence(self, texts: list[str]) -> np.ndarray:
        """Rows of unit length in each block of n: their products are the kernel, before averaging."""
        out = np.zeros((len(texts), len(self.features) + 1), np.float32)
        for row, text in zip(out, texts):
            for codes in gram_codes(text):
                row[self.column[codes]] = 1
        return normalised(out[:, :-1], self.blocks)

    def score(self, texts: list[str]) -> np.ndarray:
        return self.presence(texts) @ self.weights


def normalised(presence: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    for a, b in zip(blocks, blocks[1:]):
        norms = np.sqrt(presence[:, a:b].sum(axis=1, keepdims=True))
        presence[:, a:b] /= np.maximum(norms, 1) * 2  # the average over four blocks, half of it on each side
    return presence


def fit(examples: list[tuple[str, np.ndarray]]) -> Model | None:
    """Model of `(language, distinct n-gram codes)` pairs, in a fixed order."""
    languages = sorted({lang for lang, _ in examples})
    if not languages:
        return None
    y = np.array([languages.index(lang) for lang, _ in examples])
    each = max(1, LANDMARKS // len(languages))
    marks = np.sort(np.concatenate([m[: min(each, max(1, len(m) // 4))] for m in (np.flatnonzero(y == c) for c in range(len(languages)))]))
    features = np.unique(np.concatenate([examples[i][1] for i in marks]))
    model = Model(languages, features, np.zeros((len(features), len(languages))))
    phi = np.zeros((len(examples), len(features) + 1), np.float32)
    for row, (_, codes) in zip(phi, examples):
        row[model.column[codes]] = 1
    phi = normalised(phi[:, :-1], model.blocks)
    landmark = phi[marks]
    to_marks = (phi @ landmark.T).astype(np.float64)
    values, vectors = np.linalg.eigh(to_marks[marks])
    keep = values > 1e-6 * values.max(initial=1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    z = to_marks @ root
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    w = np.linalg.solve(z.T @ z + RIDGE * np.eye(z.shape[1]), z.T @ target)
    model.weights = (landmark.T.astype(np.float64) @ (root @ w)).astype(np.float32)
    return model


def examples(df: DataFrame) -> list[tuple[str, np.ndarray]]:
    """A bounded sample of labelled documents; only the distinct n-grams come to the driver."""
    learn = df.filter((F.crc32(F.col("doc_id").cast("string")) % 4 != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    learn = learn.select("doc_id", "lang", "text")
    number = learn.select("lang").distinct().count()
    if not number:
        return []
    order = W.partitionBy("lang").orderBy("h", "doc_id")
    ids = learn.select("lang", "doc_id", F.xxhash64("doc_id").alias("h")).withColumn("_n", F.row_number().over(order))
    ids = ids.filter(F.col("_n") <= max(1, TRAIN_DOCUMENTS // number)).select("lang", "doc_id")
    # At most TRAIN_DOCUMENTS ids.
    chosen = learn.join(F.broadcast(ids.distinct()), ["lang", "doc_id"])

    def make():
        def run(batch):
            rows = [(*r, np.unique(np.concatenate(gram_codes(r[2]))).astype(np.int32).tobytes()) for r in zip(batch["doc_id"], batch["lang"], batch["text"]) if LETTER.search(r[2])]
            return {"doc_id": [r[0] for r in rows], "lang": [r[1] for r in rows], "codes": [r[3] for r in rows]}

        return run

    found = map_rows(chosen, make, "doc_id long, lang string, codes binary").collect()
    found.sort(key=lambda r: (r["lang"], hash((r["doc_id"], 7)), bytes(r["codes"][:64])))
    return [(r["lang"], np.frombuffer(bytes(r["codes"]), np.int32)) for r in found]


def identify(df: DataFrame, model: Model | None) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` of every row."""
    sent = df.sparkSession.sparkContext.broadcast(None if model is None else (model.languages, model.features, model.weights))

    def make():
        own = sent.value and Model(*sent.value)

        def run(batch):
            texts = [t or "" for t in batch["text"]]
            named, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if LETTER.search(t)] if own else []
            if known:
                f = own.score([texts[i] for i in known]).astype(np.float64)
                # Twice the decision value is taken as log odds.
                p = np.exp(2 * (f - f.max(axis=1, keepdims=True)))
                best = f.argmax(axis=1)
                p = p[np.arange(len(known)), best] / p.sum(axis=1)
                for i, b, s in zip(known, best.tolist(), p.tolist()):
                    named[i], scores[i] = own.languages[b], s
            held = [bool(h) for h in batch["held_out"]]
            return {"doc_id": batch["doc_id"], "held_out": held, "lang_pred": named, "score": scores}

        return run

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out")
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), held, "text")
    return map_rows(rows, make, "doc_id long, held_out boolean, lang_pred string, score double")


def languages(df: DataFrame) -> DataFrame:
    """Fits on the labelled documents that are not held out and predicts all."""
    return identify(df, fit(examples(df)))
