"""Text measures and middle truncation, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.split() and re's \s treat as whitespace; Java's \s
# alone covers only ASCII. The wide ones stand behind one range test, which most text fails at once.
WS = (
    r"\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
)
# Sentence end followed by whitespace; redaction placeholder; truncation marker.
TURN_BOUNDARY = rf"[.?!][{WS}]+"
REDACTION = r"\[[A-Z_]+\]"
TRUNCATION_MARKER = "\n\n[...transcript middle truncated for length...]\n\n"
DEFAULT_MAX_CHARS = 5000


def char_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


def token_count(text: Column) -> Column:
    """Whitespace-separated tokens, counted by the gaps between them.

    Matching whitespace is several times faster than matching the negated class.
    """
    gaps = F.regexp_count(text, F.lit(rf"[{WS}]+")).cast("bigint")
    edges = sum(edge.rlike(rf"^[{WS}]").cast("bigint") for edge in (F.left(text, F.lit(1)), F.right(text, F.lit(1))))
    return F.when(text == "", F.lit(0).cast("bigint")).otherwise(gaps + 1 - edges)


def turn_count(text: Column) -> Column:
    """Pieces left by splitting at sentence ends, a trailing empty piece included; 0 if no text."""
    return F.when(text == "", F.lit(0).cast("bigint")).otherwise(
        F.regexp_count(text, F.lit(TURN_BOUNDARY)).cast("bigint") + 1
    )


def redaction_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(REDACTION)).cast("bigint")


def check_budget(max_chars: int) -> None:
    if max_chars < 0 or 0 < max_chars <= len(TRUNCATION_MARKER):
        raise ValueError(f"max_chars must be 0 or above {len(TRUNCATION_MARKER)}")


def truncate_middle(text: Column, max_chars: int = DEFAULT_MAX_CHARS) -> Column:
    """Keep head and tail around a marker so that the result has exactly ``max_chars``."""
    check_budget(max_chars)
    if max_chars == 0:
        return text
    budget = max_chars - len(TRUNCATION_MARKER)
    head = budget // 2
    cut = F.concat(F.substring(text, 1, head), F.lit(TRUNCATION_MARKER), F.right(text, F.lit(budget - head)))
    return F.when(F.length(text) > max_chars, cut).otherwise(text)


def was_truncated(text: Column, max_chars: int = DEFAULT_MAX_CHARS) -> Column:
    check_budget(max_chars)
    return (F.length(text) > max_chars) if max_chars else F.lit(False)
