"""BPE encoding and decoding with the ranks of a public tokenizer.

A word's parts and the ranks of its adjacent pairs lie in two arrays. The least rank is found by a scan, its boundary
deleted and the two neighbouring ranks refreshed. A word above ``SHORT`` bytes goes through a queue of pairs instead, with
the same result, as the scan would take the square of its length. The vocabulary (a fixed file) goes to the executors as
one broadcast; texts never leave their partition.

Null text: empty, no tokens. Repeated rows are encoded alike, each on its own. Empty tables give empty results. Only the
id and text columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Bytes of a word up to which its ranks are scanned.
SHORT = 256
#: Words whose tokens a task remembers at a time.
REMEMBERED = 200_000
#: Characters of a text whose words are listed at once.
_LISTED = 1 << 20
_NONE = 1 << 60

# Fixed value: the pattern that splits text into words.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: itself if printable, else the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
    return letters


@dataclass
class Vocabulary:
    """``pairs``: rank of a pair of ids, as left * 2**32 + right; ``merged``: the id made by each rank."""

    byte_ids: list[int]
    pairs: dict[int, int]
    merged: list[int]
    token_bytes: list[bytes]
    special: dict[str, int]


def read_vocabulary(path: str) -> Vocabulary:
    """A byte-level vocabulary file of the tokenizers library; read once, on the driver."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    letters = byte_letters()
    ids = stored["model"]["vocab"]
    special = {t["content"]: t["id"] for t in stored["added_tokens"]}
    token_bytes = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, i in ids.items():
        token_bytes[i] = bytes(letters[c] for c in token)
    for token, i in special.items():
        token_bytes[i] = token.encode()
    pairs, merged = {}, []
    for rank, pair in enumerate(stored["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        pairs.setdefault(ids[left] << 32 | ids[right], rank)
        merged.append(ids[left + right])
    byte_ids = [0] * 256
    for letter, byte in letters.items():
        byte_ids[byte] = ids[letter]
    return Vocabulary(byte_ids, pairs, merged, token_bytes, special)


def merge_short(word: bytes, v: Vocabulary) -> list[int]:
    parts = [v.byte_ids[b] for b in word]
    rank_of = v.pairs.get
    ranks = [rank_of(a << 32 | b, _NONE) for a, b in zip(parts, parts[1:])]
    while ranks and (least := min(ranks)) != _NONE:
        i = ranks.index(least)
        parts[i] = v.merged[least]
        del parts[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = rank_of(parts[i] << 32 | parts[i + 1], _NONE)
        if i:
            ranks[i - 1] = rank_of(parts[i - 1] << 32 | parts[i], _NONE)
    return parts


def merge_long(word: bytes, v: Vocabulary) -> list[int]:
    """As ``merge_short``, with a queue by (rank, place) and links between the parts that are left."""
    parts = [v.byte_ids[b] for b in word]
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            rank = v.pairs.get(parts[i] << 32 | parts[after[i]])
            if rank is not None:
                heapq.heappush(queue, (rank, i, parts[i], parts[after[i]]))

    for i in range(n - 1):
        offer(i)
    while queue:
        rank, i, left, right = heapq.heappop(queue)
        if parts[i] != left or after[i] >= n or parts[after[i]] != right:
            continue
        gone = after[i]
        parts[i], parts[gone] = v.merged[rank], -1
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [p for p in parts if p >= 0]


class _Remembered(dict):
    """Packed ids by word, worked out at first sight."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v = v

    def __missing__(self, word: str) -> bytes:
        raw = word.encode()
        ids = (merge_short if len(raw) <= SHORT else merge_long)(raw, self.v)
        packed = np.array(ids, "<u4").tobytes()
        if len(raw) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed


class Encoder:
    def __init__(self, v: Vocabulary):
        self.v = v
        self.split = regex.compile(PATTERN)
        self.known = _Remembered(v)
        self.special = regex.compile("(" + "|".join(map(regex.escape, v.special)) + ")") if v.special else None

    def _plain(self, text: str) -> bytes:
        if len(text) <= _LISTED:
            return b"".join(map(self.known.__getitem__, self.split.findall(text)))
        found = (m[0] for m in self.split.finditer(text))
        pieces = []
        while some := list(islice(found, 1 << 16)):
            pieces.append(b"".join(map(self.known.__getitem__, some)))
        return b"".join(pieces)

    def encode(self, text: str) -> np.ndarray:
        if self.special is None:
            packed = self._plain(text)
        else:
            pieces = self.special.split(text)
            packed = b"".join(
                np.array([self.v.special[p]], "<u4").tobytes() if i % 2 else self._plain(p) for i, p in enumerate(pieces) if p
            )
        return np.frombuffer(packed, "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.v.token_bytes.__getitem__, ids.tolist())).decode("utf-8", errors="replace")


def _mapped(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str, schema: str, columns) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = [key, *(c.split()[0] for c in schema.split(", ")[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = [columns(encoder, t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c) for c in zip(*rows))], names)

    return docs.select(key, text).mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and the text decoded from them again as ``decoded``."""

    def columns(encoder: Encoder, t: str) -> tuple:
        ids = encoder.encode(t)
        return len(ids), ids.astype(np.int32), encoder.decode(ids)

    kind = docs.schema[key].dataType.simpleString()
    return _mapped(docs, vocabulary, key, text, f"`{key}` {kind}, n_tokens long, ids array<int>, decoded string", columns)


def digests(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens`` and digests of the packed ids and of the decoded text, made where the ids are."""

    def columns(encoder: Encoder, t: str) -> tuple:
        ids = encoder.encode(t)
        back = encoder.decode(ids).encode()
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(back).hexdigest()

    kind = docs.schema[key].dataType.simpleString()
    return _mapped(docs, vocabulary, key, text, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)
