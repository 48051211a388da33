"""Tokens and word limits as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_KEYWORD_LENGTH = 40  # fixed value
# Fixed value: the characters with the Unicode White_Space property.
UNICODE_BLANKS = "\t\n\v\f\r \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


def tokens(text: Column) -> Column:
    """Lower-case, drop all but ASCII letters, digits and blanks, split on blanks.

    ``(?U)`` makes ``\\s`` mean Unicode white space; without it a no-break space
    would be deleted and the words on either side would fuse.
    """
    kept = F.regexp_replace(F.lower(text), r"(?U)[^a-zA-Z0-9\s]+", "")
    return F.filter(F.split(kept, r"(?U)\s+"), lambda word: word != "")


def truncate_word(word: Column, limit: int = MAX_KEYWORD_LENGTH) -> Column:
    return F.substring(word, 1, limit)


def word_count(words: Column) -> Column:
    """Tokens including repeats; a page without text counts as zero."""
    return F.coalesce(F.size(words), F.lit(0))
