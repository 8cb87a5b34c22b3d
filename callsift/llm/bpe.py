"""Byte-level BPE: encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from callsift.llm.common import ramp, slices, table
from callsift.llm.registry import query

#: Distinct words that a worker remembers the ids of before it starts afresh.
REMEMBERED = 500_000
NO_RANK = np.int64(1) << 40
#: Fixed value: how byte-level tokenizers split text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The same split for texts of Latin letters and general punctuation alone, whose letters and digits are few ranges, so that the
#: faster of the two modules can do it; white space means the same to both but for four control characters.
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾"
PLAIN_PATTERN = rf"'(?:s|t|re|ve|m|ll|d)| ?(?:[{LETTERS}]+|[{DIGITS}]+|[^\s{LETTERS}{DIGITS}]+)|\s+(?!\S)|\s+"
NOT_PLAIN = r"[^\x00-\x1b\x20-\u024f\u2000-\u206f]"
#: Classes of characters: others, letters, digits and white space.
OTHER, LETTER, DIGIT, WHITE = range(4)


def _kinds() -> np.ndarray:
    """The class of every character, as PATTERN takes it."""
    out, every = np.full(0x110000, OTHER, np.uint8), "".join(map(chr, range(0x110000)))
    for kind, what in ((LETTER, r"\p{L}+"), (DIGIT, r"\p{N}+"), (WHITE, r"\s+")):
        for found in regex.finditer(what, every):
            out[found.start() : found.end()] = kind
    return out


def _byte_of_char() -> dict[str, int]:
    """Vocabulary files write each byte as a printable character: itself where it prints, else the next above 255."""
    printing = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """A vocabulary as flat arrays. Built from the text of a ``tokenizers`` file with a byte-level BPE model."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model, byte_of = spec["model"], _byte_of_char()
        vocab = {token: i for token, i in model["vocab"].items()}
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.token_bytes: list[bytes] = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.first = np.zeros(256, np.int64)
        for char, b in byte_of.items():
            self.first[b] = vocab.get(char, 0)
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        self.width, self.kinds = len(self.token_bytes), _kinds()
        keys = np.array([vocab[a] * self.width + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.byte_ranks = self._rank(np.repeat(self.first, 256), np.tile(self.first, 256))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has.

        All symbols lie in one array. In each round every word merges its pairs of the lowest rank, from left to right;
        only pairs next to a merge are looked up anew, and words without a mergeable pair leave.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.first[data]
        word = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(symbol), NO_RANK)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self.byte_ranks[data[inner].astype(np.int64) << 8 | data[inner + 1]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(symbol)]]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            open_ = lowest < NO_RANK
            if not open_.all():
                done.append((word[~open_], symbol[~open_]))
                symbol, word, rank, lowest = symbol[open_], word[open_], rank[open_], lowest[open_]
                if not len(symbol):
                    break
            chosen = rank == lowest
            if (chosen[1:] & chosen[:-1]).any():
                # Runs of one repeated symbol: every second pair of a run merges.
                at = np.flatnonzero(chosen)
                fresh = np.concatenate([[True], (np.diff(at) > 1) | (word[at[1:]] != word[at[:-1]])])
                run_start = np.maximum.accumulate(np.where(fresh, at, 0))
                chosen[at[(at - run_start) % 2 == 1]] = False
            at = np.flatnonzero(chosen)
            symbol[at] = self.merged[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            changed = np.zeros(len(symbol), bool)
            changed[at] = True
            symbol, word, rank, changed = symbol[keep], word[keep], rank[keep], changed[keep]
            changed[:-1] |= changed[1:]
            at = np.flatnonzero(changed)
            same = at[:-1] if len(at) and at[-1] == len(symbol) - 1 else at
            rank[at] = NO_RANK
            same = same[word[same] == word[same + 1]]
            rank[same] = self._rank(symbol[same], symbol[same + 1])
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, symbol = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def word_starts(points: np.ndarray, begins: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Which characters of some texts, of which the non-empty ones start at ``begins``, start a word of PATTERN."""
    kind, border = kinds[points], np.zeros(len(points) + 1, bool)
    border[begins] = border[-1] = True
    start = border[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # The last of some white space in front of other characters is a word of its own, or a space that opens theirs.
    white = kind == WHITE
    followed = white[:-1] & ~white[1:] & ~border[1:-1]
    start[:-1] |= followed
    start[1:] &= ~(followed & (points[:-1] == ord(" ")))
    # 's and the like are words where no word has begun before them.
    at = np.flatnonzero((points == ord("'")) & start)
    at = at[~border[at + 1]]
    one, two = points[at + 1], np.where(border[at + 2], 0, points[np.minimum(at + 2, len(points) - 1)])
    short = np.isin(one, [ord(x) for x in "stmd"])
    long = np.isin(one, [ord(x) for x in "rv"]) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[at[short | long] + 1] = False
    ends = np.concatenate([at[short] + 2, at[long] + 3])
    start[ends[ends < len(points)]] = True
    return start


class Encoder:
    """Encodes whole texts; remembers the ids of words in flat arrays."""

    def __init__(self, model: ByteBpe, remembered: int = REMEMBERED):
        self.model, self.limit = model, remembered
        self.words = regex.compile(PATTERN).findall
        self.plain, self.not_plain = re.compile(PLAIN_PATTERN).findall, re.compile(NOT_PLAIN).search
        self.special = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(model.special, key=len, reverse=True)) + ")") if model.special else None
        self._reset()

    def _reset(self) -> None:
        self.at = {word.encode(): i for i, word in enumerate(self.model.special)}
        self.ids = np.array(list(self.model.special.values()), np.int64)
        self.counts = np.ones(len(self.at), np.int64)
        self.starts = np.arange(len(self.at))

    def _split(self, text: str) -> list[str]:
        words = self.words if self.not_plain(text) else self.plain
        if self.special is None or not self.special.search(text):
            return words(text)
        return [w for part in self.special.split(text) for w in ([part] if part in self.model.special else words(part))]

    def _words(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of all texts in one array, and where each text's begin (one more than texts)."""
        whole, begins = "".join(texts), np.cumsum([0, *map(len, texts)])
        points, blob = np.frombuffer(whole.encode("utf-32-le"), np.uint32), whole.encode()
        start = word_starts(points, begins[:-1][begins[1:] > begins[:-1]], self.model.kinds)
        if self.special is not None and self.special.search(whole):
            for text, a, b in zip(texts, begins[:-1].tolist(), begins[1:].tolist()):
                if self.special.search(text):
                    start[a:b] = False
                    start[a + np.cumsum([0, *(len(w) for w in self._split(text) if w)])[:-1]] = True
        at = np.flatnonzero(start)
        place = at if len(blob) == len(points) else np.flatnonzero((np.frombuffer(blob, np.uint8) & 0xC0) != 0x80)[at]
        offsets = np.append(place, len(blob)).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(blob)])
        return words.dictionary_encode(), np.searchsorted(at, begins)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (one more than texts)."""
        words, begins = self._words(texts)
        distinct = words.dictionary.to_pylist()
        if len(self.at) > self.limit:
            self._reset()
        known = np.array([self.at.get(w, -1) for w in distinct], np.int64)
        new = np.flatnonzero(known < 0)
        if len(new):
            fresh = [distinct[i] for i in new.tolist()]
            ids, counts = self.model.encode_words(fresh)
            first = len(self.counts)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            known[new] = np.arange(first, first + len(fresh))
            self.at.update(zip(fresh, range(first, first + len(fresh))))
        index = known[words.indices.to_numpy()]
        counts = self.counts[index]
        ids = self.ids[np.repeat(self.starts[index], counts) + ramp(counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])[begins]
        return ids, ends


def load(path: str | None = None) -> ByteBpe:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return ByteBpe(file.read())


@functools.lru_cache(1)
def _encoder(model: ByteBpe) -> Encoder:
    """A worker's encoder, so that its tasks share the words it remembers."""
    return Encoder(model)


def encoded(batches: Iterator[pa.RecordBatch], model: ByteBpe) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a task's rows with the ids of their texts."""
    encoder = _encoder(model)
    for batch in slices(batches):
        yield batch, *encoder.encode([x or "" for x in batch.column("text").to_pylist()])


def shared(spark: SparkSession, path: str | None):
    """The vocabulary, read by the driver and sent once to each executor; a few MB whatever the input."""
    return spark.sparkContext.broadcast(load(path))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids array<int>``: ids of the whole text, without special tokens added.

    Special tokens written out in a text become their ids, as with the library. Null and empty texts have no ids.
    """
    model = shared(docs.sparkSession, path)

    def run(batches):
        for batch, ids, ends in encoded(batches, model.value):
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "ids"])

    docs = docs.drop("ids")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("ids", ArrayType(IntegerType()))]))


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``rows`` with ``decoded``: the text behind ``ids``; broken UTF-8 becomes replacement characters. Null ids give ''."""
    model = shared(rows.sparkSession, path)

    def run(batches):
        for batch in batches:
            texts = [model.value.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    rows = rows.drop("decoded")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("decoded", StringType())]))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row: every whole text encoded and decoded again."""
    model = shared(docs.sparkSession, path)

    def run(batches):
        names = [str(i) for i in range(model.value.width)]
        for batch, ids, ends in encoded(batches, model.value):
            rows = []
            for at, to in zip(ends[:-1].tolist(), ends[1:].tolist()):
                own = ids[at:to]
                listed = ",".join(map(names.__getitem__, own.tolist()))
                rows.append((hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(model.value.decode(own).encode()).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(np.diff(ends)), pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query()
def op4_bpe_encode_decode(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
