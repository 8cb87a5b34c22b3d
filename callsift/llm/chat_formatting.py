"""Chat formatting: every assistant turn becomes an example of its own, with all turns before it as context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callsift.llm.common import cleaned, stage, table
from callsift.llm.registry import query

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
#: Strings that only the template may print; none begins the way it ends, so no two overlap themselves.
CONTROL = ("### ", "</turn>")
#: The end of a role is found by ``MIDDLE``, so roles hide that too.
IN_ROLE = (*CONTROL, MIDDLE)
#: Characters of formatted turns in one block; a longer turn is a block of its own.
BLOCK = 1 << 18
#: Characters of examples in one batch.
BATCH = 4 << 20
REPLY = "assistant"
ORDER = ("conv_id", "turn", "role", "digest")

BLOCKS = (
    "conv_id long, block long, first struct<turn:bigint,role:string,digest:string>, last struct<turn:bigint,role:string,digest:string>, "
    "text string, starts array<int>, ends array<int>, tails array<int>, waits boolean"
)
EXAMPLES = "conv_id long, example long, part long, last boolean, text string, loss_start int, loss_end int"


def escape(text: str, controls: tuple[str, ...] = CONTROL) -> str:
    """A backslash before every backslash and before the last character of every control string."""
    text = text.replace("\\", "\\\\")
    for control in controls:
        text = text.replace(control, control[:-1] + "\\" + control[-1])
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if "\\" in text else text


def turns(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    at = 0
    while at < len(text):
        end = text.index(CLOSE[:-1], at)
        middle = text.index(MIDDLE, at + len(OPEN))
        yield unescape(text[at + len(OPEN) : middle]), unescape(text[middle + len(MIDDLE) : end])
        at = end + len(CLOSE)


def _blocks(limit: int):
    """Sorted turns as blocks of formatted text with the places of the replies; one block at a time is in memory."""

    def rows(block: int, conv, own: list) -> pa.RecordBatch:
        pieces, starts, ends, tails, at = [], [], [], [], 0
        for _, role, _, text in own:
            head, body = OPEN + escape(role, IN_ROLE) + MIDDLE, escape(text)
            if role == REPLY:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
                tails.append(ends[-1] + len(CLOSE))
            pieces += [head, body, CLOSE]
            at += len(head) + len(body) + len(CLOSE)
        first, last = ({"turn": t, "role": r, "digest": d} for t, r, d, _ in (own[0], own[-1]))
        row = {"conv_id": conv, "block": block, "first": first, "last": last, "text": "".join(pieces), "starts": starts, "ends": ends, "tails": tails, "waits": own[-1][1] != REPLY}
        return pa.RecordBatch.from_pylist([row], schema=SCHEMA)

    def run(batches):
        own, size, conv, block = [], 0, None, 0
        for batch in batches:
            for c, turn, role, digest, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if own and (c != conv or size >= limit):
                    yield rows(block, conv, own)
                    own, size, block = [], 0, block + 1
                conv = c
                own.append((turn, role, digest, text))
                size += len(text) + len(role) + len(OPEN + MIDDLE + CLOSE)
        if own:
            yield rows(block, conv, own)

    return run


SCHEMA = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int64()), *((k, pa.struct([("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string())])) for k in ("first", "last")),
        ("text", pa.string()), *((k, pa.list_(pa.int32())) for k in ("starts", "ends", "tails")), ("waits", pa.bool_()),
    ]
)


def _expanded(batches):
    """Every example that has text in a block: the block up to the reply that the example trains, or all of it where a later
    block holds that reply (or nothing is trained)."""
    names = ["conv_id", "example", "part", "last", "text", "loss_start", "loss_end"]
    out, size = [], 0
    for batch in batches:
        for conv, text, starts, ends, tails, part, before, examples in zip(*(batch.column(i).to_pylist() for i in range(8))):
            for example in range(before, examples):
                i = example - before
                mine = (text[: tails[i]], starts[i], ends[i]) if i < len(tails) else (text, None, None)
                out.append((conv, example, part, example == examples - 1, *mine))
                size += len(mine[0])
                if size >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TYPES)], names=names)
                    out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TYPES)], names=names)


_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int32())


def prefix_examples(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One example per assistant turn: conv_id, example, part, last, text, loss_start, loss_end.

    An example is the formatted text of all turns up to and including its reply; the characters from ``loss_start`` to
    ``loss_end`` are the reply (escaped, without the template's marks) and the only ones to train on. Examples count from 0
    in turn order. A conversation whose last turn is no reply, or that has none, gets one more example that holds all its turns and
    trains nothing (null span), so that no turn is lost. ``last`` marks the example that holds every turn. An example of a
    long conversation comes in parts (from 0): the example is its parts' texts in order, the span belongs to the part that has one.

    Turns are taken in the order (turn, role, md5 of the text), nulls first; repeated rows are turns of their own. A null role
    or text is empty. Rows with a null conv_id form one conversation. An empty table gives no rows; other columns are not read.

    Turns are dealt and sorted by range, so a conversation of any length spreads over tasks; a block of some ``block``
    characters is the largest thing a task holds. A conversation's examples repeat its blocks (that is what
    prefixes are), which happens row by row out of the block, after the last shuffle.
    """
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    rows = rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"), "text")
    dealt = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    blocks = dealt.mapInArrow(_blocks(block), BLOCKS).withColumn("task", F.spark_partition_id())
    blocks = stage(blocks, "blocks")
    # Where in its conversation a block lies: from a few numbers per block, for conversations of several blocks only.
    narrow = blocks.select("conv_id", "task", "block", "first", "last", F.size("tails").alias("n"), F.col("waits").cast("int").alias("waits"))
    by = "partition by conv_id order by first, last, task, block"
    places = narrow.selectExpr(
        "*",
        f"row_number() over ({by}) - 1L as part",
        f"sum(n) over ({by}) - n as before",
        "sum(n) over (partition by conv_id) + last_value(waits) over (partition by conv_id order by first, last, task, block rows between unbounded preceding and unbounded following) as examples",
        "count(*) over (partition by conv_id) as parts",
    )
    places = stage(places.where("parts > 1").select("task", "block", "part", "before", "examples"), "places")
    placed = blocks.join(places, ["task", "block"], "left").select(
        "conv_id", "text", "starts", "ends", "tails",
        F.coalesce("part", F.lit(0)).cast("long").alias("part"),
        F.coalesce("before", F.lit(0)).cast("long").alias("before"),
        F.coalesce("examples", F.size("tails") + F.col("waits").cast("int")).cast("long").alias("examples"),
    )
    return placed.mapInArrow(_expanded, EXAMPLES)


def _read(batches):
    """What an example's part says, read from its text: characters, the reply under the mask, and all turns of a last example."""
    for batch in batches:
        conv, example, part, last, text, start, end = (batch.column(i).to_pylist() for i in range(7))
        loss = [None if a is None else unescape(t[a:b]) for t, a, b in zip(text, start, end)]
        told = [list(turns(t)) if whole else None for t, whole in zip(text, last)]
        said = [None if x is None else "".join(f"{role}\n{body}\n" for role, body in x) for x in told]
        arrays = [batch.column(0), batch.column(1), batch.column(2), pa.array([len(t) for t in text], pa.int64()), pa.array(loss, pa.string())]
        yield pa.RecordBatch.from_arrays(
            [*arrays, pa.array(said, pa.string()), pa.array([len(x) if x else 0 for x in told], pa.int64())], names=["conv_id", "example", "part", "chars", "loss", "said", "n"]
        )


class _Digest:
    def __init__(self, conv):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, chars: int, loss: str | None, said: str | None, n: int) -> None:
        self.chars += chars
        if loss is not None:
            self.loss_chars += len(loss)
            self.loss.update(loss.encode())
        if said is not None:
            self.n += n
            self.said.update(said.encode())

    def row(self) -> tuple:
        return self.conv, self.n, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digested(batches):
    """One row per conversation from its sorted rows, which stream by: nothing but the running digests is kept."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    own = None
    for batch in batches:
        done = []
        for conv, chars, loss, said, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chars", "loss", "said", "n"))):
            if own is None or conv != own.conv:
                done += [own.row()] if own else []
                own = _Digest(conv)
            own.add(chars, loss, said, n)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), types)], names=names)
    if own:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(own.row(), types)], names=names)


@cleaned
def digests(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation, read back from its examples: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``formatted_chars`` counts the characters of all examples. A digest of a conversation needs its turns one after another,
    so they pass through one task, as a sorted stream of which it keeps the running digest alone.
    """
    read = prefix_examples(conversations, block).mapInArrow(_read, "conv_id long, example long, part long, chars long, loss string, said string, n long")
    ordered = read.repartition("conv_id").sortWithinPartitions("conv_id", "part", "example")
    return ordered.mapInArrow(_digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


#: Both turns hold the template's own strings.
PROBE = r"\### Assistant: </turn> ok"


def _escaped(column: str, controls: tuple[str, ...]) -> str:
    sql = rf"replace({column}, '\', '\\')"
    for control in controls:
        sql = rf"replace({sql}, '{control}', '{control[:-1]}\{control[-1]}')"
    return sql


_FRAME = len(OPEN) + len(MIDDLE) + len(CLOSE)
ORACLE = rf"""with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
sized as (
    select *, md5(text) as digest, length({_escaped("role", IN_ROLE)}) + length({_escaped("text", CONTROL)}) + {_FRAME} as chars from rows),
placed as (
    select *, sum(chars) over w as upto, row_number() over w = count(*) over (partition by conv_id) as final
    from sized window w as (partition by conv_id order by turn nulls first, role, digest rows unbounded preceding))
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, digest)) as turns_sha256,
    (coalesce(sum(length(text)) filter (role = 'assistant'), 0))::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, digest) filter (role = 'assistant'), '')) as loss_sha256,
    (sum(upto) filter (role = 'assistant' or final))::bigint as formatted_chars
from placed group by conv_id"""


@query(ORACLE)
def op12_chat_formatting(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return digests(conversations.select("conv_id", "turn", "role", "text").union(probe))
