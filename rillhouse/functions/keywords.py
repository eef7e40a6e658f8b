"""Search texts to keywords."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that is neither a letter nor a digit separates words.
SEPARATORS = r"[^\p{L}\p{N}]+"


def keyword_set(text: Column) -> Column:
    """The different words of a text, in lower case; null for a null text."""
    words = F.split(F.lower(text), SEPARATORS)
    return F.array_distinct(F.filter(words, lambda w: w != ""))
