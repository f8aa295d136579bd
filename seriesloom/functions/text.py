"""Text cleaning expressions, all evaluated by Spark without Python rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept in article text, control characters a spreadsheet cell rejects,
# and the markers an editor leaves around sub-titles.
NOT_KEPT = r"[^ㄱ-ㅎㅏ-ㅣ가-힣0-9a-zA-Z. ]"
ILLEGAL_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
EDITOR_MARKERS = "SUB_TITLE_START|SUB_TITLE_END"

# Java's Unicode white space plus the four separators that count as space in the source data's tools.
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
# The same runs without the single plain spaces, which need no replacing.
UNEVEN_SPACE = r"(?U)[\s\x1c-\x1f]{2,}|[^\S ]|[\x1c-\x1f]"
WORD_RUN = r"[\p{L}\p{N}_]{2,}"


def keep_text_characters(text: Column) -> Column:
    """Keep Hangul, ASCII digits and letters, dot and space."""
    return F.regexp_replace(text, NOT_KEPT, "")


def collapse_space(text: Column) -> Column:
    """Every run of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, UNEVEN_SPACE, " "))


def strip_illegal_control(text: Column) -> Column:
    """Remove control characters other than tab, newline and carriage return."""
    return F.regexp_replace(text, ILLEGAL_CONTROL, "")


def strip_editor_markers(text: Column) -> Column:
    """Remove sub-title markers left in article bodies."""
    return F.regexp_replace(text, EDITOR_MARKERS, "")


def title_and_body(title: Column, body: Column) -> Column:
    """Title and body joined by a space; null if either is null."""
    return F.concat(title, F.lit(" "), body)


def split_words(text: Column) -> Column:
    """Split on single spaces; two spaces in a row give an empty word."""
    return F.split(text, " ", -1)


def join_words(words: Column) -> Column:
    """Words back to one text."""
    return F.array_join(words, " ")


def spaced_tokens(text: Column) -> Column:
    """Non-empty tokens between runs of white space."""
    return F.array_remove(F.split(text, SPACE_RUN, -1), "")


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_RUN), F.lit(0))
