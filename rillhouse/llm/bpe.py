"""Byte-pair encoding and decoding with a contiguous rank array per word.

A word's parts and the ranks of its adjacent pairs stand in two short lists. The lowest rank is found
by a scan, its boundary is deleted, and the ranks to both sides are looked up again. Words of more
than ``LONG_WORD`` parts use a heap over linked parts instead, which gives the same ids in
n log n steps.

Inputs: null and empty texts give no ids. Strings of special tokens inside texts become those tokens,
as the library does by default. Extra columns of the input are not carried over; rows repeat as given.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import map_rows

LONG_WORD = 400
#: Words and cuts whose ids a Python worker remembers; further ones are encoded each time.
CACHED_WORDS = 600_000
NO_RANK = 1 << 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(spare)) for b in range(256)]


class RankArrayBpe:
    """Merges of one vocabulary file (``tokenizers`` JSON, byte-level, with or without a word-end suffix)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self.first = [vocab[c] for c in letters]
        self.last = [vocab[c + self.suffix] for c in letters]
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            self.ranks.setdefault((vocab[a], vocab[b]), len(self.merged))
            self.merged.append(vocab[a + b])
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def encode_word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        if not data:
            return []
        parts = [self.first[b] for b in data[:-1]]
        parts.append(self.last[data[-1]])
        return self._scan(parts) if len(parts) <= LONG_WORD else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        get, merged = self.ranks.get, self.merged
        ranks = [get(pair, NO_RANK) for pair in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            parts[i] = merged[low]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), NO_RANK)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        get, n = self.ranks.get, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            parts[i], alive[j] = self.merged[rank], False
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for x, y in ((before[i], i), (i, k)):
                if x >= 0 and y >= 0 and (r := get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p, live in zip(parts, alive) if live]

    def pieces(self, text: str) -> list[str]:
        """The text cut at special strings, which stand at the odd places."""
        return self.splitter.split(text) if self.splitter and any(s in text for s in self.special) else [text]


#: Word pattern of the lower-case vocabulary.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Python's split() drops these, but they are words of the pattern.
SEPARATORS = re.compile("[\x1c-\x1f]")


def lowered(text: str) -> str:
    """A text in composed form and lower case, letter by letter (no final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


class WordCodec:
    """Encodes and decodes whole texts with a lower-case vocabulary.

    No word holds white space, so texts are cut there first, and the ids of such cuts are remembered.
    """

    def __init__(self, path: str):
        self.bpe = RankArrayBpe(path)
        self.cuts: dict[str, tuple[bytes, str]] = {}
        self.words: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        ids = self.bpe.encode_word(word)
        if len(self.words) < CACHED_WORDS and len(word) < 100:
            self.words[word] = ids
        return ids

    def _cut(self, cut: str) -> tuple[bytes, str]:
        ids = [i for w in WORDS.findall(cut) for i in self.words.get(w) or self._word(w)]
        out = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(self.cuts) < CACHED_WORDS and len(cut) < 100:
            self.cuts[cut] = out
        return out

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit numbers, and the text that these ids decode to."""
        found: list[tuple[bytes, str]] = []
        known, cut = self.cuts.get, self._cut
        for i, piece in enumerate(self.bpe.pieces(text)):
            if i % 2:
                found.append((struct.pack("<I", self.bpe.special[piece]), piece))
            else:
                piece = lowered(piece)
                found += [known(w) or cut(w) for w in ([piece] if SEPARATORS.search(piece) else piece.split())]
        return b"".join([f[0] for f in found]), " ".join([f[1] for f in found if f[1]])

    def encode(self, text: str) -> list[int]:
        data = self.encode_decode(text)[0]
        return list(struct.unpack(f"<{len(data) // 4}I", data))

    def decode(self, ids: list[int]) -> str:
        """Token strings joined by blanks, special ones included: the file names no decoder. Unknown ids are skipped."""
        return " ".join([t for i in ids if (t := self.bpe.tokens.get(i)) is not None])


@lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    return WordCodec(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids (little-endian 32-bit numbers in ``ids``) and the text they decode to, per row.

    ``path`` names the vocabulary file, at the same place on all machines.
    """
    def run(keys, texts):
        both = [codec(path).encode_decode(t) for t in texts]
        return {"id": keys, "ids": [b[0] for b in both], "decoded": [b[1] for b in both]}

    return map_rows(_texts(docs, id_col, text_col), run, "doc_id long, ids binary, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode_texts`` with digests instead of ids and text: only these leave the Python worker."""
    def run(keys, texts):
        n, ids, decoded = [], [], []
        for t in texts:
            data, back = codec(path).encode_decode(t)
            n.append(len(data) // 4)
            ids.append(hashlib.sha256(data).hexdigest())
            decoded.append(hashlib.sha256(back.encode("utf-8")).hexdigest())
        return {"id": keys, "n": n, "ids": ids, "decoded": decoded}

    return map_rows(_texts(docs, id_col, text_col), run,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
