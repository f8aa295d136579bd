"""Hangul syllables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 19 initial consonants in syllable-block order; a block holds 588 syllables.
INITIAL_CONSONANTS = list("ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ")
FIRST_SYLLABLE = 0xAC00
LAST_SYLLABLE = 0xD7A3
SYLLABLES_PER_INITIAL = 588


def initial_consonant(text: Column) -> Column:
    """Initial consonant of the first syllable; null when the text does not start with one."""
    code = F.ascii(text)
    block = F.floor((code - FIRST_SYLLABLE) / SYLLABLES_PER_INITIAL).cast("int")
    letters = F.array(*[F.lit(c) for c in INITIAL_CONSONANTS])
    return F.when(code.between(FIRST_SYLLABLE, LAST_SYLLABLE), F.get(letters, block))


def index_group(text: Column) -> Column:
    """Index group of a name: its initial consonant, or ``ABC`` for any other first letter."""
    return F.coalesce(initial_consonant(text), F.lit("ABC"))
