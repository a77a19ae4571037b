"""BPE encoding and decoding by speculation and verification.

Texts are cut at white space, which no token of the vocabulary crosses, and the
pieces of a batch are encoded once each:

1. Speculate: a greedy longest match over the vocabulary proposes the tokens of
   each word.
2. Verify: every adjacent pair of proposed tokens is tested in numpy. A pair is
   compatible if merging the two tokens' symbols together gives the same two
   tokens; a word whose pairs are all compatible is encoded right.
3. Only words with a failing pair are merged rank by rank, many side by side.

The normaliser and the word pattern are those stated in the vocabulary file
(NFC, white space to one space, lower case; byte alphabet with a word-end mark).
A null text counts as empty: no tokens, empty decoded text.
"""

from __future__ import annotations

import array
import functools
import hashlib
import heapq
import itertools
import json
import unicodedata
from collections.abc import Callable

import numpy as np
import regex
from pyspark.sql import DataFrame

from plumbline.llm.frames import map_rows, stage_cache

END = "</w>"
# Encoded pieces, words and characters of pieces kept by a Python worker before it starts over.
CACHE_PIECES = 800_000
CACHE_WORDS = 600_000
CACHE_CHARS = 16_000_000
# Words of more symbols are merged with a heap, whose cost does not grow with the square of the length.
LONG_WORD = 100
# Lengths up to which words are merged side by side, each with those of about its own length.
MERGE_WIDTHS = (6, 9, 12, 16, 24, 40, LONG_WORD)
# Characters that str.split() takes as white space and the vocabulary does not.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
_SPACE = regex.compile(r"[\s--[\x1c-\x1f]]+", regex.V1)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in printable}
    others = (b for b in range(256) if b not in shown)
    return [c for _, c in sorted((shown | {b: chr(256 + i) for i, b in enumerate(others)}).items())]


_BYTES = dict(enumerate(byte_alphabet()))


class WordBpe:
    """Encoder for a vocabulary file with a word-end mark."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: t for t, i in (self.vocab | self.special).items()}
        self.numbers = {i: str(i) for i in self.texts}
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merged = [self.vocab[a + b] for a, b in merges]
        self.merged_ids = np.array(self.merged, np.int64)
        self.pair_rank = {self.vocab[a] << 32 | self.vocab[b]: r for r, (a, b) in enumerate(merges)}
        size = max(self.texts) + 1
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        keys = np.fromiter(self.pair_rank, np.int64)
        self.rank[self.merged], self.left[self.merged], self.right[self.merged] = np.arange(len(keys)), keys >> 32, keys & 0xFFFFFFFF
        self.key_ranks = np.argsort(keys)
        self.keys = keys[self.key_ranks]
        # Tokens that their own text is not encoded to can never come out, so they are not proposed.
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for text, i in self.vocab.items():
            ends = text.endswith(END)
            symbols = [*text[: -len(END)]] if ends else [*text]
            if ends and symbols:
                symbols[-1] += END
            if symbols and self.merge([self.vocab[s] for s in symbols]) == [i]:
                if ends:
                    self.final[text[: -len(END)]] = i
                else:
                    self.inner[text] = i
        self.longest_final = max(map(len, self.final))
        # The longest token that starts with each four characters (fewer at the end of a token).
        self.reach: dict[str, int] = {}
        for text in self.inner:
            for start in {text[:1], text[:2], text[:3], text[:4]}:
                self.reach[start] = max(self.reach.get(start, 1), len(text) if len(start) == 4 else len(start))
        self.symbol = {c: self.vocab[c] for c in byte_alphabet()}
        self.final_symbol = {c: self.vocab[c + END] for c in byte_alphabet()}
        self.ascii_words = regex.compile(self.words.pattern, regex.ASCII)
        codes = [ord(c) for c in self.symbol]
        self.symbol_ids, self.final_ids = (np.zeros(max(codes) + 1, np.int64) for _ in range(2))
        self.symbol_ids[codes] = list(self.symbol.values())
        self.final_ids[codes] = list(self.final_symbol.values())

    def merge(self, ids: list[int]) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost of equal ones."""
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        get, none = self.pair_rank.get, len(self.merged)
        ranks = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            ids[i] = m = self.merged[r]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(m << 32 | ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 32 | m, none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links, for words of any length."""
        n, get = len(ids), self.pair_rank.get
        before, after = [*range(-1, n - 1)], [*range(1, n), -1]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := get(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merged[r], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (s := get(ids[x] << 32 | ids[y])) is not None:
                    heapq.heappush(heap, (s, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, the number of merges where there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], len(self.merged))

    def merge_words(self, words: list[str]) -> list[list[int]]:
        """`merge` of many words in the byte alphabet at once, one merge in each word a step."""
        out: list[list[int]] = [[] for _ in words]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        group = np.searchsorted(MERGE_WIDTHS, lengths)
        for g in np.unique(group).tolist():
            which = np.flatnonzero(group == g)
            if g == len(MERGE_WIDTHS):
                for n in which.tolist():
                    ids = list(map(self.symbol.__getitem__, words[n]))
                    ids[-1] = self.final_symbol[words[n][-1]]
                    out[n] = self.merge(ids)
            else:
                for n, ids in zip(which.tolist(), self._merge_group([words[n] for n in which.tolist()], lengths[which])):
                    out[n] = ids
        return out

    def _merge_group(self, words: list[str], lengths: np.ndarray) -> list[list[int]]:
        none, wide = len(self.merged), int(lengths.max())
        codes = np.frombuffer("".join([w.ljust(wide, "\0") for w in words]).encode("utf-32-le"), np.uint32).reshape(-1, wide)
        left, rows = lengths.copy(), np.arange(len(words))
        # A last column that no word reaches, so that a place can always be looked at to the right.
        ids = np.zeros((len(words), wide + 1), np.int64)
        ids[:, :-1] = self.symbol_ids[codes]
        ids[rows, left - 1] = self.final_ids[codes[rows, left - 1]]
        ranks = np.full((len(words), wide), none)
        r, c = np.nonzero(np.arange(wide) < left[:, None] - 1)
        ranks[r, c] = self.pair_ranks(ids[r, c], ids[r, c + 1])
        out: list[list[int]] = [[] for _ in words]
        while len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            on = best < none
            done = np.flatnonzero(~on)
            for n, row, k in zip(rows[done].tolist(), ids[done].tolist(), left[done].tolist()):
                out[n] = row[:k]
            rows, at, best, left = rows[on], at[on], best[on], left[on] - 1
            here, column = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            # The place to the right of the merge closes up.
            ids = np.take_along_axis(ids[on], column + (column > at[:, None]), axis=1)
            ranks = np.take_along_axis(ranks[on], column[:-1] + (column[:-1] >= at[:, None]), axis=1)
            ids[here, at] = self.merged_ids[best]
            for k, ok in ((at - 1, at > 0), (at, at + 1 < left)):
                k = k[ok]
                ranks[here[ok], k] = self.pair_ranks(ids[here[ok], k], ids[here[ok], k + 1])
        return out

    def propose(self, word: str) -> list[int]:
        """Greedy longest match."""
        ids, at, end = [], 0, len(word)
        inner, final, reach = self.inner, self.final, self.reach
        while True:
            if end - at <= self.longest_final and (i := final.get(word[at:])) is not None:
                ids.append(i)
                return ids
            stop = at + (reach.get(word[at : at + 4]) or reach.get(word[at : at + 3]) or reach.get(word[at : at + 2]) or 1)
            if stop >= end:
                stop = end - 1
            while (i := inner.get(word[at:stop])) is None:
                stop -= 1
            ids.append(i)
            at = stop

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays as it is when their symbols are merged together.

        The merges that built the two tokens are undone from the last to the
        first. What then meets at the seam must have no merge that would have
        come before the one just undone.
        """
        good = np.ones(len(a), bool)
        x, y = a.copy(), b.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        live = np.arange(len(a))
        while len(live):
            key = x << 32 | y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            good[live[(self.keys[at] == key) & (self.key_ranks[at] < limit)]] = False
            rx, ry = self.rank[x], self.rank[y]
            # Equal ranks: the left token was merged first, so the right one is undone first.
            undo_x = rx > ry
            limit = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            on = good[live] & ((rx >= 0) | (ry >= 0))
            live, x, y, limit = live[on], x[on], y[on], limit[on]
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, given in the byte alphabet without its end mark."""
        proposed = list(map(self.propose, words))
        lengths = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter(itertools.chain.from_iterable(proposed), np.int64, lengths.sum())
        last = np.cumsum(lengths) - 1
        inside = np.ones(len(flat), bool)
        inside[last] = False
        owner = np.repeat(np.arange(len(words)), lengths)[inside]
        first = np.flatnonzero(inside)
        keys, which = np.unique(flat[first] << 32 | flat[first + 1], return_inverse=True)
        good = self.compatible(keys >> 32, keys & 0xFFFFFFFF)
        failing = np.unique(owner[~good[which]]).tolist()
        for n, ids in zip(failing, self.merge_words([words[n] for n in failing])):
            proposed[n] = ids
        return proposed

    def pieces_words(self, piece: str) -> list[str | int]:
        """Words of a piece without white space in the byte alphabet; ids of special tokens."""
        if piece.isascii() and piece.isalpha():
            return [piece.lower()]
        if piece.isascii() and piece.isprintable() and "<|" not in piece:
            return self.ascii_words.findall(piece.lower())
        out: list[str | int] = []
        for part in self.specials.split(piece) if "<|" in piece else (piece,):
            if part in self.special:
                out.append(self.special[part])
            else:
                # Lower case character by character: no special form of a final sigma.
                lower = "".join(map(str.lower, unicodedata.normalize("NFC", part)))
                out += (w.encode().decode("latin-1").translate(_BYTES) for w in self.words.findall(lower))
        return out


def pieces_of(text: str) -> list[str]:
    """The text cut at white space."""
    if any(c in text for c in _NOT_SPACE):
        return [p for p in _SPACE.split(text) if p]
    return text.split()


@functools.cache
def encoder(path: str) -> WordBpe:
    """One encoder for each Python worker."""
    return WordBpe(path)


class PieceCache:
    """Encoded pieces in the form a caller needs, made once each.

    `render` gives the form of a word's ids, `join` that of several words.
    Pieces without tokens are None.
    """

    def __init__(self, path: str, render: Callable[[WordBpe, list[int]], object], join: Callable[[list], object]) -> None:
        self.bpe, self.render, self.join = encoder(path), render, join
        self.words: dict[str | int, object] = {}
        self.pieces: dict[str, object] = {}
        self.gaps = False
        self.chars = 0

    def _learn(self, new: list[str]) -> None:
        self.chars += sum(map(len, new))
        split = list(map(self.bpe.pieces_words, new))
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        known, render, bpe = self.words, self.render, self.bpe
        missing = set(itertools.chain.from_iterable(split)).difference(known)
        words = [w for w in missing if isinstance(w, str)]
        known.update((w, render(bpe, ids)) for w, ids in zip(words, bpe.encode_words(words)))
        known.update((i, render(bpe, [i])) for i in missing.difference(words))
        for piece, ws in zip(new, split):
            if len(ws) == 1:
                self.pieces[piece] = known[ws[0]]
            else:
                self.pieces[piece] = self.join([known[w] for w in ws]) if ws else None
                self.gaps = self.gaps or not ws

    def texts(self, texts: list[str | None]) -> list[list]:
        """For each text, the rendered pieces that have tokens."""
        split = [pieces_of(t or "") for t in texts]
        if len(self.pieces) > CACHE_PIECES or self.chars > CACHE_CHARS:
            self.pieces.clear()
            self.words.clear()
            self.chars = 0
        if new := set().union(*split).difference(self.pieces):
            self._learn(list(new))
        get = self.pieces.__getitem__
        if self.gaps:
            return [[r for r in map(get, ps) if r is not None] for ps in split]
        return [list(map(get, ps)) for ps in split]


def _string_cache(path: str) -> PieceCache:
    def render(bpe: WordBpe, ids: list[int]) -> tuple[str, str]:
        return " ".join(map(bpe.numbers.__getitem__, ids)), " ".join(map(bpe.texts.__getitem__, ids))

    return PieceCache(path, render, lambda forms: tuple(map(" ".join, zip(*forms))))


def _id_cache(path: str) -> PieceCache:
    return PieceCache(path, lambda bpe, ids: array.array("I", ids).tobytes(), b"".join)


def _cached(make: Callable[[str], PieceCache], path: str) -> PieceCache:
    held = stage_cache()
    if (make, path) not in held:
        held[make, path] = make(path)
    return held[make, path]


def encode(texts: list[str | None], path: str) -> list[tuple[str, str]]:
    """Decimal ids joined by spaces, and the decoded text, of each text."""
    out = []
    for pieces in _cached(_string_cache, path).texts(texts):
        ids, shown = zip(*pieces) if pieces else ((), ())
        out.append((" ".join(ids), " ".join(shown)))
    return out


def encode_ids(texts: list[str | None], path: str) -> list[bytes]:
    """The ids of each text as native unsigned 32-bit numbers."""
    return list(map(b"".join, _cached(_id_cache, path).texts(texts)))


def decode_ids(ids: list[int], path: str) -> str:
    """The tokens' texts joined by spaces, as the file names no decoder; unknown ids are left out."""
    texts = encoder(path).texts
    return " ".join(texts[i] for i in ids if i in texts)


def encode_table(df: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """`(id, ids array<int>, decoded)` of every row; null text gives no ids and an empty text."""

    def make():
        def run(batch):
            found = encode(batch["text"], path)
            return {
                "id": batch["id"],
                "ids": [[*map(int, i.split())] for i, _ in found],
                "decoded": [d for _, d in found],
            }

        return run

    kind = df.schema[id_column].dataType.simpleString()
    out = map_rows(df.selectExpr(f"`{id_column}` AS id", f"`{text}` AS text"), make, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_column)


def encoding_digests(df: DataFrame, path: str) -> DataFrame:
    """Token count and SHA-256 of the ids and of the decoded text of each document.

    Repeated rows give a row each; `doc_id` may be null.
    """

    def make():
        def run(batch):
            found = encode(batch["text"], path)
            return {
                "doc_id": batch["doc_id"],
                "n_tokens": [ids.count(" ") + 1 if ids else 0 for ids, _ in found],
                "ids_sha256": [hashlib.sha256(ids.encode()).hexdigest() for ids, _ in found],
                "decoded_sha256": [hashlib.sha256(shown.encode()).hexdigest() for _, shown in found],
            }

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_rows(df.select(df["doc_id"].cast("long"), df["text"]), make, schema)
