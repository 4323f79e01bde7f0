"""Packing documents into sequences by exact-complement hashing.

A document is its token ids and one end id; one longer than a sequence is cut into full pieces and a rest. Packing depends on
lengths alone, and there are at most ``capacity`` of them, so it is planned from the count of each length. The plan
opens a sequence with the longest length left. Three indexes tell for every gap whether one, two or three lengths that are left
sum to it exactly; such a combination fills the sequence. Where there is none, the longest length that fits is put in (best fit) and
the rest of the gap is looked up again. A pattern found is used as often as its lengths are available, so the plan is a
list of patterns and copies, whose size depends on the number of lengths and not on the number of documents. The indexes count
sums over the set of lengths left and are kept up as lengths run out.

Pieces are numbered within their length by the task that makes them and the counts of the tasks before it; nothing is sorted or
grouped by length, so a length that a third of all documents have is no hot key. Number and length give a piece its place in
the plan. Texts are read once; what is kept of a piece is its digest and place, or its ids too where asked for.

A null or empty text is the end id alone. A text of any length is encoded whole. Repeated rows and equal ids are documents of
their own. An empty table gives no rows. Columns other than the two are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.workspace import materialise

CAPACITY = 4096
END = 1
#: Parts of words whose ids a Python worker remembers; others are encoded in each block anew.
REMEMBERED = 600_000
#: Bytes of text encoded at once; a longer text makes a block of its own.
BLOCK_BYTES = 8 << 20


# ---- encoding


class WordEncoder:
    """Ids of words, by the library; the ids of a text are those of its words.

    Split points are the six ASCII white-space characters. The tokenizer drops white space, none of its patterns spans any, and
    neither composition nor lower-casing reaches across it, so a text may be cut there. Words of ASCII and Latin-1 letters are
    cut further by the tokenizer's own pattern, which makes more of them equal; their normal form is lower case alone. All
    other words, and those with ``<``, which may hold a special token, go to the tokenizer as they are.
    """

    # The pattern by which the tokenizer splits, over ASCII and the letters of Latin-1 in lower case.
    PART = r"('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+)"
    PLAIN = r"^[!-;=-~À-ÖØ-öø-ÿ]+$"
    _END_OF_PART = "</w>"
    _JOINED = 200

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.parts = Tokenizer.from_file(path)
        for tokenizer in (self.whole, self.parts):
            tokenizer.no_truncation()
            tokenizer.no_padding()
        self.parts.normalizer = None
        split = pre_tokenizers.WhitespaceSplit()
        self.parts.pre_tokenizer = pre_tokenizers.Sequence([split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(self._END_OF_PART)]] = True
        self.known: dict[str, bytes] = {}

    def _encode(self, parts: list[str]) -> dict[str, bytes]:
        found = {}
        for i in range(0, len(parts), self._JOINED):
            some = parts[i : i + self._JOINED]
            ids = np.array(self.parts.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw, start = ids.tobytes(), 0
                for part, end in zip(some, (ends * 4).tolist()):
                    found[part] = raw[start:end]
                    start = end
            else:
                for part in some:
                    found[part] = _raw(self.whole.encode(part, add_special_tokens=False).ids)
        return found

    def _plain(self, words: pa.Array) -> pa.Array:
        """The ids of words that ``PLAIN`` matches, as bytes; parts are worked on once, wherever they stand."""
        split = pc.split_pattern(pc.replace_substring_regex(pc.utf8_lower(words), self.PART, r"\1 "), " ")
        coded = split.flatten().dictionary_encode()
        parts = coded.dictionary.to_pylist()
        known = self.known
        fresh = self._encode([p for p in parts if p and p not in known])
        raw = [known[p] if p in known else fresh.get(p, b"") for p in parts]
        if len(known) < REMEMBERED:
            known.update(fresh)
        joined = pa.array(raw, pa.large_binary()).take(coded.indices)
        return _regrouped(joined, split.offsets.to_numpy() - split.offsets[0].as_py())

    def words(self, words: pa.Array) -> pa.Array:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        plain = pc.match_substring_regex(words, self.PLAIN).to_numpy(zero_copy_only=False)
        odd = self.whole.encode_batch(words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)
        both = pa.concat_arrays([self._plain(words.filter(pa.array(plain))), pa.array([_raw(e.ids) for e in odd], pa.large_binary())])
        at = np.where(plain, np.cumsum(plain) - 1, plain.sum() + np.cumsum(~plain) - 1)
        return both.take(pa.array(at))

    def texts(self, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
        """The ids of all texts end to end, as bytes, and where those of each one start and end."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        raw = self.words(words.dictionary).take(words.indices)
        places = split.offsets.to_numpy() - split.offsets[0].as_py()
        return memoryview(raw.buffers()[2] or b""), _offsets(raw)[places]


def _offsets(raw: pa.Array) -> np.ndarray:
    """Where each value of an unsliced binary array starts, and where the last one ends."""
    return np.frombuffer(raw.buffers()[1], np.int64)[: len(raw) + 1] if len(raw) else np.zeros(1, np.int64)


def _regrouped(raw: pa.Array, groups: np.ndarray) -> pa.Array:
    """Values that follow each other joined into one; ``groups`` tells where each group starts, and where the last one ends."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(groups) - 1, [None, pa.py_buffer(_offsets(raw)[groups]), raw.buffers()[2]])


def _raw(ids: Sequence[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One for each Python worker, so that it remembers words from task to task."""
    return WordEncoder(path)


def _blocks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + BLOCK_BYTES, "right")) - 1)
        yield first, last
        first = last


def _cut(path: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).texts
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = _raw([END])
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for first, last in _blocks(texts):
                raw, places = encode(texts.slice(first, last - first))
                row, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
                for i in range(last - first):
                    own = raw[places[i] : places[i + 1]]
                    n = len(own) // 4 + 1
                    for k, at in enumerate(range(0, n, capacity)):
                        size = min(capacity, n - at)
                        part = own[4 * at : 4 * (at + size)]
                        digest = zlib.crc32(part)
                        if at + size == n:
                            digest = zlib.crc32(end, digest)
                        row.append(first + i)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(digest)
                        nth.append(seen[size])
                        seen[size] += 1
                        if with_ids:
                            ids.append(np.frombuffer(bytes(part) + (end if at + size == n else b""), "<u4").astype(np.int32))
                columns = [keys.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(c, pa.int64()) for c in (start, length, crc, nth)]
                columns.append(pa.array([task] * len(row), pa.int32()))
                names = ["id", "piece", "start", "length", "ids_crc32", "nth", "task"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every piece: ``id``, ``piece``, ``start``, ``length``, ``ids_crc32``, with ``task`` and ``nth`` (which of this length in its task)."""
    fields = [T.StructField("id", docs.schema[key].dataType), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "nth")]
    fields.append(T.StructField("task", T.IntegerType()))
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    named = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    # Written, as numbers within a task hold for this one division into tasks only.
    return materialise(named.mapInArrow(_cut(tokenizer, capacity, with_ids), T.StructType(fields)), "pieces")


# ---- planning


class SumIndex:
    """For each sum, in how many ordered ways one, two or three of the lengths left make it."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(np.int64)
        self.one = (self.counts > 0).astype(np.int64)
        self.two = np.convolve(self.one, self.one)[: len(counts)]
        self.three = np.convolve(self.two, self.one)[: len(counts)]

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if self.counts[length]:
            return
        a, size = length, len(self.counts)
        if 3 * a < size:
            self.three[3 * a] += -1
        if 2 * a < size:
            self.three[2 * a :] += 3 * self.one[: size - 2 * a]
        self.three[a:] -= 3 * self.two[: size - a]
        if 2 * a < size:
            self.two[2 * a] += 1
        self.two[a:] -= 2 * self.one[: size - a]
        self.one[a] = 0

    def _pair(self, total: int, used: Counter) -> list[int]:
        """The two lengths nearest to each other, all but those in use."""
        if total < 2 or not self.two[total]:
            return []
        low = np.arange(1, total // 2 + 1)
        for a in low[(self.one[low] > 0) & (self.one[total - low] > 0)][::-1].tolist():
            b = total - a
            if self.counts[a] - used[a] > (a == b) and self.counts[b] - used[b] > 0:
                return [b, a]
        return []

    def exact(self, gap: int, used: Counter) -> list[int]:
        """One, two or three lengths that fill ``gap``, given what is in ``used`` already; none if there are none."""
        if self.counts[gap] > used[gap]:
            return [gap]
        pair = self._pair(gap, used)
        if pair or gap < 3 or not self.three[gap]:
            return pair
        longest = np.arange(gap - 2, 0, -1)
        for a in longest[(self.one[longest] > 0) & (self.two[gap - longest] > 0)].tolist():
            if self.counts[a] > used[a]:
                pair = self._pair(gap - a, used + Counter([a]))
                if pair:
                    return [a, *pair]
        return []

    def longest(self, most: int, used: Counter) -> int:
        """The longest length left of at most ``most``; 0 if there is none."""
        for a in np.flatnonzero(self.one[: most + 1])[::-1].tolist():
            if self.counts[a] > used[a]:
                return a
        return 0


def plan(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns of lengths and how many sequences follow each, for ``counts`` of the lengths from 0 to the capacity."""
    capacity = len(counts) - 1
    left = SumIndex(counts)
    patterns = []
    for base in range(capacity, 0, -1):
        while left.counts[base]:
            lengths, used, gap = [base], Counter([base]), capacity - base
            while gap:
                more = left.exact(gap, used)
                if not more:
                    fits = left.longest(gap, used)
                    if not fits:
                        break
                    more = [fits]
                lengths += more
                used.update(more)
                gap -= sum(more)
            copies = int(min(left.counts[a] // n for a, n in used.items()))
            for a, n in used.items():
                left.take(a, n * copies)
            patterns.append((lengths, copies))
    return patterns


def _places(patterns: list[tuple[list[int], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Stretches of pieces, in order of length and number: the first of each, its sequence, and the place in it."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for lengths, copies in patterns:
        at = 0
        for a in lengths:
            rows.append((a, taken[a], sequence, at))
            taken[a] += copies
            at += a
        sequence += copies
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else tuple(np.zeros(0, np.int64) for _ in range(4))


#: Pieces of one length that a plan can number.
_NUMBERS = 1 << 48


def _place(stretches: tuple[np.ndarray, ...]):
    lengths, firsts, sequences, offsets = stretches
    starts = lengths * _NUMBERS + firsts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy()
            found = np.searchsorted(starts, batch.column("length").to_numpy() * _NUMBERS + number, "right") - 1
            kept = [c for c in batch.schema.names if c != "number"]
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(sequences[found] + number - firsts[found]), pa.array(offsets[found])]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    return run


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of ``cut`` with ``sequence_id`` and ``offset``."""
    by_task = materialise(pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # One number for each length there is, at most ``capacity``.
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    # By length, one row a task.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = pieces.join(first, ["task", "length"]).withColumn("number", F.col("first") + F.col("nth"))
    numbered = numbered.select(*[c for c in pieces.columns if c not in ("task", "nth")], "number")
    fields = [f for f in numbered.schema.fields if f.name != "number"]
    fields += [T.StructField(c, T.LongType()) for c in ("sequence_id", "offset")]
    return numbered.mapInArrow(_place(_places(plan(counts), capacity)), T.StructType(fields))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` of every piece."""
    return pack_pieces(cut(docs, tokenizer, capacity, key, text), capacity).withColumnRenamed("id", key)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids``, and ``starts`` of the pieces in it (at most ``capacity`` ids a row)."""
    placed = pack_pieces(cut(docs, tokenizer, capacity, key, text, with_ids=True), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))
