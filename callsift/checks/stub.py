"""A deterministic model for tests: the outcome depends on the transcript length and the attempt."""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLASSES = 12


def document(**changes) -> dict:
    """A minimal valid extraction document."""
    doc = {
        "agent": {"name": None, "professionalism_score": 4, "empathy_score": 3, "knowledge_score": 5},
        "customer": {"intent_primary": "billing", "satisfaction_score": 3, "effort_score": "low"},
        "outcome": {"resolution_summary": "done", "complexity_score": 2},
        "events": {},
        "quality": {},
        "summary": "ok",
        "key_quotes": ["a"],
        "coaching_opportunities": [],
    }
    for path, value in changes.items():
        target = doc
        *parents, name = path.split("__")
        for parent in parents:
            target = target[parent]
        target[name] = value
    return doc


def transcript_of(request: dict) -> str:
    content = json.loads(request["body"])["messages"][-1]["content"]
    return content.split("\n", 1)[1]


def stub_reply(request: dict):
    size, attempt = len(transcript_of(request)), request["attempt"]
    usage = {"prompt_tokens": size, "completion_tokens": size % 50 + attempt}
    good = {"content": json.dumps(document()), "usage": usage}
    kind = size % CLASSES
    if kind == 2 and attempt == 1:
        return {**good, "content": good["content"] + " and that is all"}
    if kind == 3:
        return {**good, "content": "```json" + good["content"] + "```"}
    if kind == 5 and attempt < 3:
        return TimeoutError("no answer")
    if kind == 6:
        return ConnectionError("refused")
    if kind == 7:
        return {**good, "content": json.dumps(document(agent__empathy_score=6))}
    if kind == 8:
        return RuntimeError("broken")
    if kind == 9:
        return {"usage": usage}
    if kind == 10:
        return {**good, "content": document()}
    return good


def stub_model(requests: list[dict]) -> list:
    return [stub_reply(request) for request in requests]


def always_right(requests: list[dict]) -> list:
    return [{"content": json.dumps(document()), "usage": {"prompt_tokens": "many"}} for _ in requests]
