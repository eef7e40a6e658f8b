"""Token counts by a whole-token shortcut.

Offline, every vocabulary string that the pre-tokenizer leaves in one piece is run through the merges
once; those that end as the one token itself are proven whole. A pre-token found among them counts 1
without any merging; only the rest is merged, and its count remembered.

Inputs: null and empty texts have no tokens. A special string inside a text counts as one token. Extra
columns of the input are not carried over; rows repeat as given.
"""

from __future__ import annotations

import re
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.bpe import RankArrayBpe, byte_letters
from rillhouse.llm.common import map_rows

#: Word pattern of the byte-level vocabulary.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
TWO_SPACES = re.compile(r"\s\s")
#: Cuts whose counts a Python worker remembers; further ones are merged each time.
CACHED_WORDS = 1_200_000
LIMIT = 512


def whole_tokens(bpe: RankArrayBpe) -> set[str]:
    """Vocabulary strings that are one pre-token and encode to exactly their own id."""
    back = {c: b for b, c in enumerate(byte_letters())}
    found = set()
    for i, token in bpe.tokens.items():
        if token in bpe.special:
            continue
        try:
            text = bytes(back[c] for c in token).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if PRE_TOKENS.findall(text) == [text] and bpe.encode_word(text) == [i]:
            found.add(text)
    return found


class TokenCounter:
    """Counts tokens; a text without adjacent white space is cut at its blanks, as each blank then begins
    a pre-token, and the counts of such cuts are remembered together with the proven ones."""

    def __init__(self, path: str):
        self.bpe = RankArrayBpe(path)
        self.whole = whole_tokens(self.bpe)
        #: Counts of what follows a blank, counted with the blank.
        self.after_blank = {t[1:]: 1 for t in self.whole if t[0] == " " and len(t) > 1}
        self.room = CACHED_WORDS

    def _plain(self, text: str) -> int:
        whole = self.whole
        return sum([1 if w in whole else len(self.bpe.encode_word(w)) for w in PRE_TOKENS.findall(text)])

    def _cut(self, cut: str) -> int:
        n = self._plain(" " + cut)
        if self.room > 0 and len(cut) < 100:
            self.after_blank[cut] = n
            self.room -= 1
        return n

    def count(self, text: str) -> int:
        total, known, cut = 0, self.after_blank.get, self._cut
        for i, piece in enumerate(self.bpe.pieces(text)):
            if i % 2:
                total += 1
            elif TWO_SPACES.search(piece):
                total += self._plain(piece)
            else:
                first, *rest = piece.split(" ")
                total += self._plain(first) + sum([known(w) or cut(w) for w in rest])
        return total


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    return TokenCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Bytes and tokens of each text, and whether it has more than ``limit`` tokens.

    ``path`` names the vocabulary file, at the same place on all machines.
    """
    def run(keys, texts):
        n = [counter(path).count(t) for t in texts]
        return {"id": keys, "bytes": [len(t.encode("utf-8")) for t in texts], "n": n, "over": [x > limit for x in n]}

    texts = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    return map_rows(texts, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
