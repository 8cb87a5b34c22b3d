"""Whole-document JSON parsing.

The native parser stops at the end of the first value and refuses duplicate keys and NaN. Wrapping
the text in an array with a closing sentinel makes it read the whole text; the few documents it
still refuses, and those that hold the sentinel themselves, go through Python's json module, which
decides and words the error. Documents that parse natively never leave the JVM: the Python function
sees null for them.

Documents may be nested to any depth. Of one that is too deep for the native parser (998 levels), the variant holds
``KEPT_DEPTH`` levels, and what lies below them stays in it as JSON text. A valid document that is too large for the variant type is an error of its own
(document_too_large): none is cut.
"""

from __future__ import annotations

import json
import re
import sys
from json.decoder import scanstring

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SENTINEL = "~end-of-document~"
# Stands for NaN, infinities and broken strings, wrapped in a list: no field rule accepts it.
NOT_STORABLE = "~not-storable~"
# Far fewer levels than parsing allows: functions that print a variant recurse several frames a level.
KEPT_DEPTH = 250
DETAIL_CHARS = 300
# White space and numbers of JSON, and the words it knows besides.
BLANK = re.compile(r"[ \t\n\r]*")
NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?")
WORDS = {"null": None, "true": True, "false": False, "NaN": ..., "Infinity": ..., "-Infinity": ...}
CLOSING = {"[": "]", "{": "}"}


def _finite(text: str):
    value = float(text)
    return value if value - value == 0 else [NOT_STORABLE]


def _storable(value, depth: int = 1):
    """Strings that are no valid UTF-8 become the stand-in; keys that are not are kept in escaped form."""
    if isinstance(value, (dict, list)) and depth > KEPT_DEPTH:
        raise RecursionError
    if isinstance(value, dict):
        return {k.encode("utf-8", "backslashreplace").decode(): _storable(v, depth + 1) for k, v in value.items()}
    if isinstance(value, list):
        return [_storable(v, depth + 1) for v in value]
    if isinstance(value, str) and _lone_surrogate(value):
        return [NOT_STORABLE]
    return value


def _lone_surrogate(text: str) -> bool:
    return any("\ud800" <= ch <= "\udfff" for ch in text)


class _Open:
    """A container that has begun: its value so far, or nothing but its place where it lies below the kept levels."""

    def __init__(self, text: str, start: int, depth: int):
        self.closing, self.start, self.key = CLOSING[text[start]], start, None
        self.value = None if depth > KEPT_DEPTH else {} if self.closing == "}" else []

    def put(self, value) -> None:
        if self.value is None:
            return
        if self.closing == "}":
            self.value[self.key] = value
        else:
            self.value.append(value)


def _blank(text: str, at: int) -> int:
    return BLANK.match(text, at).end()


def _simple(text: str, at: int):
    """A value that is no container, and where it ends."""
    if text.startswith('"', at):
        return scanstring(text, at + 1)
    for word, value in WORDS.items():
        if text.startswith(word, at):
            return ([NOT_STORABLE] if value is ... else value), at + len(word)
    number = NUMBER.match(text, at)
    if number is None:
        raise json.JSONDecodeError("Expecting value", text, at)
    whole = number[1] is None and number[2] is None
    return (int(number[0]) if whole else _finite(number[0])), number.end()


def loads_any_depth(text: str):
    """The value of one JSON document, read with a stack of its own instead of recursion.

    Containers below ``KEPT_DEPTH`` levels are checked like all others and become their own text.
    """
    stack: list[_Open] = []
    at = _blank(text, 0)
    while True:
        if stack and stack[-1].closing == "}":
            at = _member(text, at, stack[-1])
        if text.startswith(("[", "{"), at):
            stack.append(_Open(text, at, len(stack) + 1))
            at = _blank(text, at + 1)
            if not text.startswith(stack[-1].closing, at):
                continue
            value, at = _closed(text, at, stack)
        else:
            value, at = _simple(text, at)
        # Hand the value up, through all containers that end here.
        while stack:
            stack[-1].put(value)
            at = _blank(text, at)
            if text.startswith(",", at):
                comma, at = at, _blank(text, at + 1)
                if text.startswith(stack[-1].closing, at):
                    kind = "object" if stack[-1].closing == "}" else "array"
                    raise json.JSONDecodeError(f"Illegal trailing comma before end of {kind}", text, comma)
                break
            if not text.startswith(stack[-1].closing, at):
                raise json.JSONDecodeError("Expecting ',' delimiter", text, at)
            value, at = _closed(text, at, stack)
        else:
            at = _blank(text, at)
            if at < len(text):
                raise json.JSONDecodeError("Extra data", text, at)
            return value


def _member(text: str, at: int, own: _Open) -> int:
    """Reads a key into its object; the result is where the key's value begins."""
    if not text.startswith('"', at):
        raise json.JSONDecodeError("Expecting property name enclosed in double quotes", text, at)
    own.key, at = scanstring(text, at + 1)
    at = _blank(text, at)
    if not text.startswith(":", at):
        raise json.JSONDecodeError("Expecting ':' delimiter", text, at)
    return _blank(text, at + 1)


def _closed(text: str, at: int, stack: list[_Open]):
    own = stack.pop()
    return (text[own.start : at + 1] if own.value is None else own.value), at + 1


def canonical_or_error(text: str) -> tuple[str | None, str | None]:
    # Room for the deepest value that is kept, which takes a few frames per level.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 10 * KEPT_DEPTH))
    try:
        try:
            value = _storable(json.loads(text, parse_float=_finite, parse_constant=lambda _: [NOT_STORABLE]))
        except RecursionError:
            value = _storable(loads_any_depth(text))
        return json.dumps(value), None
    except ValueError as error:
        return None, f"json_parse_error: {type(error).__name__}: {str(error)[:DETAIL_CHARS]}"


_OPINION = T.StructType([T.StructField("canonical", T.StringType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_OPINION)
def _second_opinion(texts: pd.Series) -> pd.DataFrame:
    rows = [(None, None) if text is None else canonical_or_error(text) for text in texts]
    return pd.DataFrame(rows, columns=["canonical", "error"], dtype="object")


def variant_kind(value: Column) -> Column:
    """OBJECT, or the type of any other value. Does not walk through the object's content."""
    is_object = F.try_variant_get(value, "$", "struct<_: variant>").isNotNull()
    return F.when(is_object, F.lit("OBJECT")).otherwise(F.schema_of_variant(value))


def parse_json_strict(df: DataFrame, column: str, doc: str = "doc", error: str = "parse_error", required: bool = True) -> DataFrame:
    """Adds ``doc`` (variant) and ``error`` (null when the text is one valid document).

    A null text is an empty document, which is an error; without ``required`` it has neither document nor error.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{SENTINEL}"]')))
    # Exactly two elements: the document and the sentinel.
    complete = (F.try_variant_get(F.col("_whole"), "$[1]", "string") == SENTINEL) & F.try_variant_get(F.col("_whole"), "$[2]", "variant").isNull()
    complete &= ~F.contains(text, F.lit(SENTINEL))
    parsed = df.withColumn("_whole", wrapped).withColumn(
        "_native", F.when(complete, F.try_variant_get(F.col("_whole"), "$[0]", "variant"))
    )
    judged = parsed.withColumn("_second", _second_opinion(F.when(F.col("_native").isNull() & (F.lit(required) | F.col(column).isNotNull()), text)))
    canonical = F.try_parse_json(F.col("_second.canonical"))
    return (
        judged.withColumn(doc, F.coalesce(F.col("_native"), canonical))
        .withColumn(
            error,
            F.when(F.col(doc).isNotNull() | (F.lit(not required) & F.col(column).isNull()), F.lit(None).cast("string")).otherwise(
                F.coalesce(F.col("_second.error"), F.lit("document_too_large: valid JSON above the limit of the variant type"))
            ),
        )
        .drop("_whole", "_native", "_second")
    )
