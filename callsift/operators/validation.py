"""Lax validation of the extraction document, as Column expressions over a variant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callsift.functions.json_strict import parse_json_strict
from callsift.functions.stages import settle
from callsift.functions.text import WS
from callsift.schemas import LEAVES, SECTIONS, Leaf, section_leaves

MESSAGE_CHARS = 500
# Spellings accepted for booleans (any case) and the score range.
TRUE_WORDS = ("true", "yes", "y", "on", "t", "1")
FALSE_WORDS = ("false", "no", "n", "off", "f", "0")
LOWEST, HIGHEST = 1, 5
# An integer in text form: sign, digits with single underscores between, a zero fraction.
INTEGER_TEXT = rf"^[{WS}]*[+]?([0-9]+(?:_[0-9]+)*)(?:[.]0+)?[{WS}]*\z"


def _as_text(leaf: Column) -> Column:
    return F.try_variant_get(leaf, "$", "string")


def _check(leaf: Column) -> Column:
    """One leaf with its rule -> its value in the field of its kind, and what is wrong with it.

    Written once over all leaves rather than once per leaf, which keeps the plan small.
    """
    source, kind = leaf["source"], leaf["kind"]
    found = F.schema_of_variant(source)
    text = _as_text(source)
    is_text = found == "STRING"
    is_number = (found == "BIGINT") | found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT")
    number = F.try_variant_get(source, "$", "double")
    truth = F.try_variant_get(source, "$", "boolean")

    digits = F.regexp_replace(F.regexp_extract(text, INTEGER_TEXT, 1), "_", "")
    whole = (
        F.when(is_number & (number == F.floor(number)), number)
        .when(is_text, digits.try_cast("double"))
        .when((found == "BOOLEAN") & truth, F.lit(1.0))
    )
    score = F.when((kind == "score") & whole.between(LOWEST, HIGHEST), whole.cast("tinyint"))

    word = F.lower(text)
    flag = F.when(
        kind == "flag",
        F.when(found == "BOOLEAN", truth)
        .when(is_number & number.isin(0.0, 1.0), number == 1.0)
        .when(is_text & word.isin(*TRUE_WORDS), F.lit(True))
        .when(is_text & word.isin(*FALSE_WORDS), F.lit(False)),
    )
    string = F.when(
        is_text & ((kind == "text") | ((kind == "choice") & F.array_contains(leaf["choices"], text))), text
    )
    items = F.when(kind == "texts", F.try_variant_get(source, "$", "array<variant>"))
    all_text = F.forall(items, lambda item: F.schema_of_variant(item) == "STRING")
    texts = F.when((F.size(items) <= leaf["cap"]) & all_text, F.transform(items, _as_text))

    value = F.struct(score.alias("score"), flag.alias("flag"), string.alias("text"), texts.alias("texts"))
    nothing = score.isNull() & flag.isNull() & string.isNull() & texts.isNull()
    allowed_null = leaf["nullable"] & F.is_variant_null(source)
    problem = F.when(source.isNull(), F.when(leaf["required"], F.lit("missing"))).when(
        nothing & ~allowed_null, leaf["expected"]
    )
    return F.struct(
        value.alias("value"),
        F.when(leaf["present"] & problem.isNotNull(), F.concat(leaf["path"], F.lit(": "), problem)).alias("problem"),
    )


def _expected(leaf: Leaf) -> str:
    return {
        "score": f"not an integer from {LOWEST} to {HIGHEST}",
        "flag": "not a boolean",
        "text": "not a string",
        "choice": "not one of " + ", ".join(leaf.choices),
        "texts": f"not a list of at most {leaf.cap} strings",
    }[leaf.kind]


def _sql(value) -> str:
    """A fixed value of the rule table as a SQL literal."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, tuple):
        return "cast(array(" + ", ".join(_sql(v) for v in value) + ") as array<string>)"
    return "'" + value.replace("'", "''") + "'"


def _holder(leaf: Leaf) -> str:
    return f"_{leaf.section}" if leaf.section else "_top"


def _rule(leaf: Leaf) -> str:
    fields = {
        "path": leaf.path,
        "kind": leaf.kind,
        "required": leaf.required,
        "nullable": leaf.nullable,
        "choices": leaf.choices,
        "cap": leaf.cap,
        "expected": _expected(leaf),
    }
    fixed = ", ".join(f"'{name}', {_sql(value)}" for name, value in fields.items())
    holder = _holder(leaf)
    return f"named_struct({fixed}, 'present', {holder} is not null, 'source', {holder}.{leaf.name})"


def _filled(place: int, leaf: Leaf) -> str:
    field = {"choice": "text"}.get(leaf.kind, leaf.kind)
    default = f"cast({_sql(leaf.default)} as {leaf.spark_type.simpleString()})"
    return f"'{leaf.name}', if({_holder(leaf)}.{leaf.name} is null, {default}, _checks[{place}].value.{field})"


def _variants(names) -> str:
    return "struct<" + ", ".join(f"{name}: variant" for name in names) + ">"


def validate_extraction(
    df: DataFrame, doc: str = "doc", out: str = "extraction", error: str = "validation_error"
) -> DataFrame:
    """Adds the typed document (null if invalid) and the error text (null if valid).

    The document is taken apart once per level; unknown keys are ignored, absent optional fields
    get their defaults.
    """
    top_leaves = section_leaves(None)
    level1 = df.withColumn(
        "_top", F.try_variant_get(F.col(doc), "$", _variants([*SECTIONS, *(x.name for x in top_leaves)]))
    )
    level2 = level1.withColumns(
        {
            f"_{s}": F.try_variant_get(F.col(f"_top.{s}"), "$", _variants(x.name for x in section_leaves(s)))
            for s in SECTIONS
        }
    )

    # The parts repeated per leaf are SQL text: one parse instead of a call per expression.
    rules = F.expr("array(" + ", ".join(_rule(leaf) for leaf in LEAVES) + ")")
    structure = F.array(
        F.when(F.col("_top").isNull(), F.lit("document: not an object")),
        *[
            F.when(F.col("_top").isNotNull() & F.col(f"_{s}").isNull(), F.lit(f"{s}: missing or not an object"))
            for s in SECTIONS
        ],
    )
    checked = level2.withColumn("_checks", F.transform(rules, _check))
    problems = F.array_compact(F.concat(structure, F.transform("_checks", lambda c: c["problem"])))
    listed = checked.withColumn("_problems", problems)

    places = list(enumerate(LEAVES))
    parts = [
        f"'{s}', named_struct(" + ", ".join(_filled(i, x) for i, x in places if x.section == s) + ")" for s in SECTIONS
    ]
    parts += [_filled(i, x) for i, x in places if x.section is None]
    typed = F.expr("named_struct(" + ", ".join(parts) + ")")
    count = F.size("_problems")
    message = F.concat(count.cast("string"), F.lit(" invalid: "), F.array_join("_problems", "; "))
    return settle(
        listed,
        {
            out: F.when(count == 0, typed),
            error: F.when(count > 0, F.concat(F.lit("validation_error: "), F.left(message, F.lit(MESSAGE_CHARS)))),
        },
        drop=["_top", "_checks", "_problems", *[f"_{s}" for s in SECTIONS]],
    )


def judge_responses(df: DataFrame, content: str = "content", call_error: str | None = None) -> DataFrame:
    """Model output text -> extraction, extraction_status, error_message.

    ``call_error`` names a column with an earlier failure of the call itself, which wins.
    """
    checked = validate_extraction(parse_json_strict(df, content))
    earlier = F.col(call_error) if call_error else F.lit(None).cast("string")
    message = F.coalesce(
        earlier,
        F.col("parse_error"),
        F.col("validation_error"),
    )
    return (
        checked.withColumn("error_message", message)
        .withColumn("extraction", F.when(F.col("error_message").isNull(), F.col("extraction")))
        .withColumn(
            "extraction_status", F.when(F.col("error_message").isNull(), "success").otherwise("error")
        )
        .drop("doc", "parse_error", "validation_error")
    )


def error_taxonomy(rows: DataFrame, *keys: str) -> DataFrame:
    """Error rows counted by class, the part of the message in front of the first colon."""
    return (
        rows.filter(F.col("error_message").isNotNull())
        .groupBy(*keys, F.split_part("error_message", F.lit(":"), F.lit(1)).alias("error_class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
