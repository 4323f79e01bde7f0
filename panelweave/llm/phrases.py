"""Document fingerprints by locally consistent parsing.

Each level cuts a string of names into phrases and names each phrase by its content. Where to cut is told by deterministic
coin tossing: every name is replaced by the lowest bit in which it differs from the one before and the value of that bit,
until few labels are left; local maxima begin a phrase. A cut thus depends on a few names around it and on no offset, so equal
substrings are cut and named alike but for a few phrases at their ends. Level one starts from the UTF-8 bytes; runs of
one name are taken as one when cuts are sought and spelt out when phrases are named.

A fingerprint keeps, for each of ``BINS`` ranges of the names of the last level, one byte of the least name (00: none).
Likeness is the share of bins that agree among those that either text has: an estimate of the Jaccard similarity of
the phrase sets. Equal texts have equal fingerprints, and two empty texts a likeness of 1.

Null text: empty. A lone document is its own next one. Null ids come last in descending order, rows of one id in the
order of their texts. Rows repeated wholly have equal results. Ids are numbers. Texts of any length are parsed whole. An empty table
gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweave.llm import words as W

BINS = 64
#: Levels of phrases; those of the third are about thirty bytes long.
LEVELS = 3
#: Rows of a batch worked on at once.
_ROWS = 512


@lru_cache(maxsize=None)
def _tossed(size: int) -> np.ndarray:
    """The label of a pair of labels below ``size``, as a flat table."""
    a, b = np.meshgrid(np.arange(size, dtype=np.uint64), np.arange(size, dtype=np.uint64), indexing="ij")
    return _toss(a.ravel(), b.ravel()).astype(np.uint8)


def _toss(before: np.ndarray, names: np.ndarray) -> np.ndarray:
    differ = names ^ before
    lowest = differ & (~differ + np.uint64(1))
    place = np.bitwise_count(lowest - np.uint64(1))
    return 2 * place.astype(np.uint8) + ((names & lowest) != 0)


def cuts(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places where phrases begin; ``first`` marks where texts do."""
    kept = first.copy()
    kept[1:] |= names[1:] != names[:-1]
    kept[:1] = True
    at = np.flatnonzero(kept)
    own, start = names[at], first[at]
    # A text's first name is labelled by its own lowest bit, as if the name before differed there.
    if own.dtype == np.uint8:
        size, label = 256, own
    else:
        size, label = 128, np.empty(len(own), np.uint8)
        label[1:] = _toss(own[:-1], own[1:])
        label[start] = (own[start] & np.uint64(1)).astype(np.uint8)
    while size > 8:
        table = _tossed(size)
        index = np.empty(len(label), np.uint16)
        index[1:] = label[:-1].astype(np.uint16) * np.uint16(size) + label[1:]
        index[:1] = 0
        following = table[index]
        following[start] = label[start] & 1
        label, size = following, 16 if size > 16 else 8
    higher = np.ones(len(label), bool)
    higher[1:] &= label[1:] > label[:-1]
    inner = np.flatnonzero(~start[1:])
    higher[inner] &= label[inner] > label[inner + 1]
    return at[start | higher]


def phrase_names(block: W.Block, levels: int = LEVELS) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of the last level, and the text of each."""
    n = len(block.data)
    begin = block.offsets[:-1][block.offsets[:-1] < block.offsets[1:]]
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.zeros(n, bool)
    first[begin] = True
    at = cuts(block.data, first)
    names = W.hash_spans(block.data, at, np.append(at[1:], n))
    text = np.searchsorted(block.offsets, at, "right") - 1
    for _ in range(1, levels):
        first = np.append(True, text[1:] != text[:-1])
        at = cuts(names, first)
        names, text = W.hash_names(names, at, np.append(at[1:], len(names))), text[at]
    return names, text


def fingerprints(texts: pa.Array, levels: int = LEVELS) -> np.ndarray:
    """A row of ``BINS`` bytes for each text."""
    out = np.zeros((len(texts), BINS), np.uint8)
    for block in W.blocks(texts):
        names, text = phrase_names(block, levels)
        least = np.full((block.last - block.first) * BINS, 2**64 - 1, np.uint64)
        bins = (names >> np.uint64(58)).astype(np.int64)
        np.minimum.at(least, text * BINS + bins, W.mix(names))
        found = np.where(least == 2**64 - 1, 0, 1 + least % np.uint64(255)).astype(np.uint8)
        out[block.first : block.last] = found.reshape(-1, BINS)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    either = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(either == 0, 1.0, same / np.maximum(either, 1))


def _hex(prints: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in prints]


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", levels: int = LEVELS) -> DataFrame:
    """``key`` and ``fingerprint`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array(_hex(fingerprints(batch.column(1), levels)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], [key, "fingerprint"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(key: str, levels: int):
    names = [key, *(c.split()[0] for c in _RESULT.split(", ")[1:])]

    def rows(ids: Sequence, own: list[str], following: list[str]) -> pa.RecordBatch:
        changed = [edited(a, b) for a, b in zip(own, following)]
        mine = fingerprints(pa.array(own, pa.large_string()), levels)
        # The next text is the next row's, but for the last one.
        last = fingerprints(pa.array(following[-1:], pa.large_string()), levels)
        theirs = fingerprints(pa.array(changed, pa.large_string()), levels)
        columns = [pa.array(ids, pa.int64()), pa.array([len(t) for t in own], pa.int64())]
        columns += [pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(_hex(mine)), pa.array(_hex(theirs))]
        columns += [pa.array(likeness(mine, theirs)), pa.array(likeness(mine, np.concatenate([mine[1:], last])))]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (range, extra, id, text) of one range after the other, its extra rows last."""
        held: tuple | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                found = list(zip(*(part.column(i).to_pylist() for i in range(4))))
                found = ([held] if held else []) + [(r, extra, i, t or "") for r, extra, i, t in found]
                held = found.pop()
                ends = [*found[1:], held]
                # Behind the first extra row of a range, nothing of it is left to compare.
                pairs = [(a, b) for a, b in zip(found, ends) if a[0] == b[0] and not a[1]]
                if pairs:
                    yield rows([a[2] for a, _ in pairs], [a[3] for a, _ in pairs], [b[3] for _, b in pairs])

    return run


def fingerprint_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", levels: int = LEVELS) -> DataFrame:
    """Every document against its edited text and against the next one in descending order of ``key``.

    Documents are dealt once, into ranges of ids as many as there are shuffle partitions; the first document of each
    range also goes to the range before it (the very first to the last range), so no range waits for another.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = F.approx_percentile("id", [i / ranges for i in range(1, ranges)] or [0.5], 20 * ranges)
    bounds = rows.select("id").agg(marks.alias("bounds")).first()["bounds"]
    splits = [float("-inf"), *sorted({float(b) for b in bounds or [0]}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="as_double", outputCol="bucket", handleInvalid="keep")
    # Range 0 is for rows without an id; the others go up with the id.
    bucket = F.when(F.col("id").isNull(), 0).otherwise(F.col("bucket").cast("int") + 1)

    def placed(frame: DataFrame) -> DataFrame:
        return cut.transform(frame.withColumn("as_double", F.col("id").cast("double"))).withColumn("range", bucket)

    # One row for each range, whatever the number of documents.
    firsts = sorted(placed(rows.select("id")).groupBy("range").agg(F.max("id").alias("id")).collect(), reverse=True)
    before = [firsts[i - 1]["range"] for i in range(len(firsts))]
    extra = spark.createDataFrame([(f["id"], b) for f, b in zip(firsts, before)], "first long, before int")
    kept = F.array(F.struct("range", F.lit(False).alias("extra")))
    also = F.array(F.struct(F.col("range"), F.lit(False).alias("extra")), F.struct(F.col("before").alias("range"), F.lit(True).alias("extra")))
    dealt = placed(rows).join(F.broadcast(extra), F.col("id").eqNullSafe(F.col("first")), "left")
    dealt = dealt.withColumn("to", F.explode(F.when(F.col("before").isNull(), kept).otherwise(also)))
    dealt = dealt.select("to.range", "to.extra", "id", "text").repartitionById(len(splits) + 1, "range")
    order = ["range", "extra", F.col("id").desc_nulls_last(), "text"]
    return dealt.sortWithinPartitions(*order).mapInArrow(_compare(key, levels), f"`{key}` {_RESULT}")
