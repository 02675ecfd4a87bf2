"""Text rules: whitespace, chunk packing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that separate words, and the default budgets in characters.
WHITESPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
WORD_CHARACTER = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
CHUNK_BUDGET = 380
LONG_TEXT = 512


def pack_words(text: Column, max_chars: int = CHUNK_BUDGET) -> Column:
    """Greedy whole-word packing of a text into pieces of at most ``max_chars`` characters.

    With single spaces between words, the longest piece that fits is the longest match that ends before
    a space or the end, which one regular expression finds for the whole text; a word over the budget
    stands alone. Null, empty, short and blank texts are returned as they are.
    """
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    spaced = F.trim(F.regexp_replace(text, WHITESPACE, " "))
    piece = rf"[^ ].{{0,{max_chars - 1}}}(?= |\z)|[^ ]{{{max_chars + 1},}}"
    packed = F.regexp_extract_all(spaced, F.lit(f"(?s){piece}"), F.lit(0))
    verbatim = text.isNull() | (F.length(text) <= max_chars) | ~text.rlike(WORD_CHARACTER)
    return F.when(verbatim, F.array(text)).otherwise(packed)
