"""JSON strictness and lax validation, against json and (where installed) pydantic."""

import json
from typing import Literal, Optional

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callsift import schemas
from callsift.checks.stub import document
from callsift.functions import json_strict
from callsift.functions.json_strict import parse_json_strict
from callsift.operators.validation import error_taxonomy, judge_responses

TEXTS = [
    '{"a":1}', ' {"a":1} \n', '{"a":1} x', '{"a":1}}', '{"a":1},{"b":2}', '{"a":1}] y', "{'a':1}", "", " ", "[1]", "null", "3", '"s"',
    '{"a":1,"a":2}', '{"a":NaN}', '{"a":-Infinity}', '{"a":1e999}', '{"a":01}', '{"a":1.}', '{"a":.5}', '{"a":1,}', "﻿{}",
    '{"a":"\t"}', '{"a":"\\u00e9"}', '{"a":"\\ud800"}', "```json{}```", "{", '{"a":"\\x"}', "true", "True", "[" * 2000 + "]" * 2000,
]


def test_whole_document_parsing_matches_json(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = parse_json_strict(df, "t").select("i", F.col("doc").isNotNull(), "parse_error").collect()
    for i, parsed, error in rows:
        try:
            json.loads(TEXTS[i])
            assert parsed and error is None, TEXTS[i][:40]
        except ValueError as failure:
            assert not parsed and error == f"json_parse_error: {type(failure).__name__}: {str(failure)[:300]}"


INTS = [3, 3.0, "3", " 3 ", "3.0", "3.00", "03", "+3", "0_3", True, 3.5, "3.", "3e0", "x", [3], None, False, 0, 6, "3_0", "_3", "3_", 1, 5, "5", -1, 1e30, {}, "٣"]
BOOLS = [True, False, 1, 0, 1.0, 0.0, "yes", "NO", "On", "off", "t", "F", "1", "0", "Y", "n", "true", 2, 0.5, "", " true ", "maybe", None, "null", [], "2"]
STRINGS = ["", "x", 3, True, [], None, {"a": 1}]
EFFORTS = ["low", "Low", " low", "", "high", None, 1]
QUOTES = [[], ["a"], ["a", "b", "c"], ["a", "b", "c", "d"], "a", None, ["a", 1], ["a", None], {"a": 1}]


def cases():
    made = [document()]
    for path, values in {
        "agent__empathy_score": INTS, "quality__profanity_or_abuse": BOOLS, "agent__greeting_compliant": BOOLS,
        "summary": STRINGS, "agent__name": STRINGS, "customer__effort_score": EFFORTS, "customer__sentiment_end": ["positive", "bad", None],
        "key_quotes": QUOTES, "coaching_opportunities": [["x"] * 5, ["x"] * 6], "outcome__resolution_status": ["resolved", "Resolved"],
        "unknown": [1, None], "agent__unknown": ["x"], "agent": [None, [], "x", {}], "events": [{}, None, 3], "quality": [{"audio_quality_issues_mentioned": 1}],
    }.items():
        made += [document(**{path: v}) for v in values]
    for missing in ("summary", "agent", "events", "key_quotes"):
        made.append({k: v for k, v in document().items() if k != missing})
    for section, name in (("agent", "empathy_score"), ("customer", "effort_score"), ("customer", "sentiment_end"), ("agent", "name")):
        doc = document()
        doc[section].pop(name, None)
        made.append(doc)
    return [json.dumps(c) for c in made] + ["[1]", "null", "3", '"x"', "{}"]


def reference_model():
    """The same rules as a pydantic model built from the rule table."""
    pydantic = pytest.importorskip("pydantic")
    kinds = {"flag": bool, "text": str, "texts": list[str]}

    def model(name, leaves, extra):
        fields = dict(extra)
        for leaf in leaves:
            limits = {"score": {"ge": 1, "le": 5}, "texts": {"max_length": leaf.cap}}.get(leaf.kind, {})
            kind = int if leaf.kind == "score" else Literal[leaf.choices] if leaf.kind == "choice" else kinds[leaf.kind]
            default = ... if leaf.required else (list(leaf.default) if leaf.kind == "texts" else leaf.default)
            fields[leaf.name] = (Optional[kind] if leaf.nullable else kind, pydantic.Field(default, **limits))
        return pydantic.create_model(name, **fields)

    sections = {s: (model(s, schemas.section_leaves(s), {}), ...) for s in schemas.SECTIONS}
    return model("Document", schemas.section_leaves(None), sections), pydantic.ValidationError


def test_validation_matches_pydantic(spark):
    model, invalid = reference_model()
    texts = cases()
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string")
    rows = judge_responses(df, "raw").select("i", "extraction_status", "error_message", F.to_json("extraction", {"ignoreNullFields": "false"})).collect()
    assert len(rows) == len(texts)
    for i, status, message, extraction in rows:
        try:
            expected = model.model_validate(json.loads(texts[i])).model_dump()
        except invalid:
            assert status == "error" and message.startswith("validation_error: ") and extraction is None, texts[i]
            continue
        assert status == "success" and message is None, (texts[i], message)
        assert json.loads(extraction) == expected, texts[i]


def test_problems_are_named_and_bounded(spark):
    doc = document(agent__empathy_score=9, customer__effort_score="Low")
    del doc["summary"]
    df = spark.createDataFrame([(json.dumps(doc),), ("{}",)], "raw string")
    first, second = [r.error_message for r in judge_responses(df, "raw").collect()]
    assert "agent.empathy_score: not an integer" in first and "customer.effort_score" in first and "summary: missing" in first
    assert first.startswith("validation_error: 3 invalid")
    assert second.startswith("validation_error: 6 invalid: agent: missing") and len(second) <= 500 + len("validation_error: ")


def test_type_of_the_stored_document(spark):
    df = spark.createDataFrame([(json.dumps(document()),)], "raw string")
    stored = judge_responses(df, "raw").schema["extraction"].dataType
    assert stored.simpleString() == schemas.EXTRACTION_TYPE.simpleString()
    assert len(schemas.LEAVES) == 37


def test_taxonomy_uses_the_text_before_the_colon(spark):
    df = spark.createDataFrame([("api_error: T: x",), ("api_error: y",), ("exhausted retries",), (None,)], "error_message string")
    assert {tuple(r) for r in error_taxonomy(df).collect()} == {("api_error", 2), ("exhausted retries", 1)}


def same_as_json(text):
    def outcome(read):
        try:
            return "value", read(text)
        except ValueError as error:
            return "error", str(error)

    expected = outcome(lambda t: json.loads(t, parse_float=json_strict._finite, parse_constant=lambda _: [json_strict.NOT_STORABLE]))
    assert outcome(json_strict.loads_any_depth) == expected, text


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.floats() | st.text(), lambda x: st.lists(x) | st.dictionaries(st.text(), x)), st.integers(0, 200), st.sampled_from(["", ",", "]", "}", '"', ":", " ", "[", "{", "1", "\\"]))
def test_reading_with_a_stack_matches_json(value, cut, odd):
    text = json.dumps(value, indent=1)
    at = cut % (len(text) + 1)
    for t in (text, text[:at] + odd + text[at:], text[:at] + odd, text[:at] + odd + text[at + 1 :]):
        same_as_json(t)


def test_stack_reader_on_known_texts():
    for text in TEXTS:
        if len(text) < 1000 and not text.startswith("﻿"):
            same_as_json(text)


def test_deep_documents_keep_their_depth_as_text(spark):
    levels = 1500
    unknown = json.dumps({**document(), "unknown": 1}).replace('"unknown": 1', '"unknown": ' + "[" * levels + "7" + "]" * levels)
    rows = judge_responses(spark.createDataFrame([(unknown,), (unknown + "]",)], "raw string"), "raw").collect()
    assert [r.extraction_status for r in rows] == ["success", "error"]
    canonical, error = json_strict.canonical_or_error("[" * levels + "7" + "]" * levels)
    inner = json.loads(canonical)
    for _ in range(json_strict.KEPT_DEPTH):
        (inner,) = inner
    below = levels - json_strict.KEPT_DEPTH
    assert error is None and inner == "[" * below + "7" + "]" * below
