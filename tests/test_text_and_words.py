"""Text and word features against Python's own string, re and statistics modules."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from callsift.functions import text as tx
from callsift.operators import prepare, word_table
from callsift.schemas import WORDS_TYPE

TEXTS = [
    "", " ", "Hi there. Bye! ", "one", " lead and trail ", "a b　c\x1cd e\x85f", "Ok. Yes?\x1dNo!",
    "emoji 😀 [PERSON_NAME] [[CITY]] [name] [A_B][C]", "dots... and. more.\n\nend.", "  ", "x​y", "tab\tnew\nline\x0bvt",
]


def python_text_features(text):
    return (
        len(text),
        len(text.split()),
        len(re.split(r"[.?!]\s+", text)) if text else 0,
        len(re.findall(r"\[[A-Z_]+\]", text)),
    )


def test_text_measures_match_python(spark):
    t = F.col("text")
    df = spark.createDataFrame([(i, text) for i, text in enumerate(TEXTS)], "i int, text string")
    rows = df.select("i", tx.char_count(t), tx.token_count(t), tx.turn_count(t), tx.redaction_count(t)).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {i: python_text_features(s) for i, s in enumerate(TEXTS)}


@pytest.mark.parametrize("limit", [0, 51, 60, 61, 100])
def test_truncation(spark, limit):
    texts = ["", "x" * 51, "y" * 52, "".join(chr(97 + i % 26) for i in range(101)), "😀" * 120]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", tx.truncate_middle(F.col("t"), limit), tx.was_truncated(F.col("t"), limit)).collect()
    for text, short, cut in rows:
        assert cut == (limit > 0 and len(text) > limit)
        if not cut:
            assert short == text
        else:
            budget = limit - len(tx.TRUNCATION_MARKER)
            head, tail = short.split(tx.TRUNCATION_MARKER)
            assert len(short) == limit and len(head) == budget // 2
            assert text.startswith(head) and text.endswith(tail)


@pytest.mark.parametrize("limit", [1, 50, -1])
def test_truncation_rejects_limits_within_the_marker(limit):
    with pytest.raises(ValueError):
        tx.truncate_middle(F, limit)


def python_word_features(words, duration):
    conf = [float(w[2] or 0.0) for w in words]
    if len(conf) > 1:
        p10 = statistics.quantiles(sorted(conf), n=100, method="inclusive")[9]
    else:
        p10 = conf[0] if conf else 0.0
    gaps = [int(b[0] or 0) - int(a[1] or 0) for a, b in zip(words, words[1:])]
    gaps = [g for g in gaps if g > 0]
    silence = sum(gaps) / 1000
    return {
        "word_confidence_mean": statistics.fmean(conf) if conf else 0.0,
        "word_confidence_min": min(conf, default=0.0),
        "word_confidence_p10": p10,
        "low_confidence_word_pct": sum(c < 0.7 for c in conf) / len(conf) if conf else 0.0,
        "silence_total_sec": silence,
        "silence_max_gap_sec": max(gaps, default=0) / 1000,
        "silence_pct_of_call": silence / duration if duration else 0.0,
    }


def sample_calls():
    rng = random.Random(7)
    calls = {"empty": [], "one": [(5.0, 10.0, 0.7)], "none": [(None, None, None)] * 3, "edge": [(0.0, 5.9, 0.7), (9.2, 3.0, 0.0)]}
    for i in range(40):
        calls[f"c{i}"] = [
            (
                None if rng.random() < 0.1 else float(rng.randint(0, 5000)),
                None if rng.random() < 0.1 else float(rng.randint(0, 5000)),
                None if rng.random() < 0.1 else rng.random(),
            )
            for _ in range(rng.choice([1, 2, 3, 11, 40]))
        ]
    return calls


def test_word_features_match_python(spark):
    calls = sample_calls()
    data = [(k, "a b", words, 12.5 if i % 3 else None, None) for i, (k, words) in enumerate(calls.items())]
    schema = f"call_id string, text string, words {WORDS_TYPE.simpleString()}, audio_duration double, confidence double"
    rows = prepare.compute_features(spark.createDataFrame(data, schema)).collect()
    for row, (_, _, words, duration, _) in zip(sorted(rows, key=lambda r: r.call_id), sorted(data)):
        for name, value in python_word_features(words, duration).items():
            assert row[name] == pytest.approx(value, abs=1e-9), (row.call_id, name)
        assert row.word_count == (len(words) or 2)
        assert row.audio_duration_sec == (duration or 0.0) and row.asr_confidence_overall == 0.0
        assert row.words_per_minute == pytest.approx((row.word_count / duration * 60) if duration else 0.0)


@pytest.mark.parametrize("chunk, levels", [(1, 1), (7, 2), (7, 3), (1 << 20, 1), (5, 0)])
def test_word_table_matches_arrays_for_any_chunk_size(spark, chunk, levels):
    calls = {k: w for k, w in sample_calls().items() if w}
    rng = random.Random(3)
    calls["hot"] = [(float(i * 10), float(i * 10 + rng.randint(0, 30)), rng.random()) for i in range(3000)]
    data = [(k, i * 3, s, e, c) for k, words in calls.items() for i, (s, e, c) in enumerate(words)]
    words = spark.createDataFrame(data, "call_id string, pos bigint, start double, end double, confidence double")
    silence = {r.call_id: r for r in word_table.silence_features(words, chunk, levels).collect()}
    scores = {r.call_id: r for r in word_table.confidence_features(words).collect()}
    assert set(silence) == set(scores) == set(calls)
    for key, content in calls.items():
        expected = python_word_features(content, None)
        for name in ("silence_total_sec", "silence_max_gap_sec"):
            assert silence[key][name] == pytest.approx(expected[name], abs=1e-9)
        for name in ("word_confidence_mean", "word_confidence_min", "word_confidence_p10", "low_confidence_word_pct"):
            assert scores[key][name] == pytest.approx(expected[name], abs=1e-9), (key, name)


def test_word_table_ratios(spark):
    words = spark.createDataFrame([("a", 0, 0.0, 100.0, 1.0), ("a", 1, 600.0, 700.0, 0.5)], "call_id string, pos bigint, start double, end double, confidence double")
    durations = spark.createDataFrame([("a", 2.0)], "call_id string, audio_duration double")
    row = word_table.word_table_features(words, durations).first()
    assert row.words_per_minute == 60.0 and row.silence_pct_of_call == 0.25


def test_stored_features_have_storage_types_and_text_only_zeroes(spark):
    df = spark.createDataFrame([("a", "Hello there. [NAME] x")], "call_id string, text string")
    row = prepare.pack_features(prepare.features_from_text(df)).select("features.*").first()
    assert (row.char_count, row.word_count, row.turn_count_estimate, row.redacted_token_count) == (21, 4, 2, 1)
    assert row.words_per_minute == row.word_confidence_p10 == row.silence_total_sec == 0.0


def test_enrich_measures_the_full_text(spark):
    schema = f"call_id string, text string, words {WORDS_TYPE.simpleString()}, audio_duration double, confidence double"
    row = prepare.enrich(spark.createDataFrame([("a", "word " * 100, None, None, None)], schema), 60).first()
    assert row.features.char_count == row.transcript_length_chars == 500
    assert len(row.transcript_text) == 60 and row.was_truncated
