"""Quality rules: how much of a text repeats itself.

Words are hashed once; n-grams of growing length are rolled from the hashes of the length before, and only places whose
shorter n-gram was found twice are looked at again, as a longer n-gram cannot repeat where a shorter one does not. Work
and memory are those of a block of texts, and no row leaves its partition.

Null text: no words. Empty tables give empty results. Repeated rows are judged alike, each on its own. Only the id and
text columns are read by ``measure``; ``keep`` returns all columns as they came.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelweave.llm import words as W

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_ROLL = np.uint64(0xC2B2AE3D27D4EB4F)


# The published limits for long web pages.
LONG_TOP = ((2, 0.20), (3, 0.18), (4, 0.16))
LONG_REPEATED = ((5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10))


@dataclass(frozen=True)
class Rules:
    """Largest shares that a kept text may have.

    ``top``: characters in the occurrences of the most frequent n-gram, by n. ``repeated``: characters covered by
    n-grams that occurred before, by n. Lines: those equal to an earlier line, and their characters. ``symbols``: symbol
    characters a word. ``min_words`` and ``max_repeat_percent`` are the base rule. Texts of ``long_words`` words and more
    are held to the limits named ``long_``; shorter ones, which one line that stands twice would carry past these, to the others.
    Both have the same lengths of n-grams.
    """

    top: tuple[tuple[int, float], ...] = ((2, 0.25), (3, 0.25), (4, 0.25))
    repeated: tuple[tuple[int, float], ...] = ((5, 0.25), (6, 0.25), (7, 0.25), (8, 0.25), (9, 0.25), (10, 0.25))
    lines: float = 0.40
    line_chars: float = 0.30
    long_words: int = 1000
    long_top: tuple[tuple[int, float], ...] = LONG_TOP
    long_repeated: tuple[tuple[int, float], ...] = LONG_REPEATED
    long_lines: float = 0.30
    long_line_chars: float = 0.20
    symbols: float = 0.10
    min_words: int = 50
    max_repeat_percent: int = 50


def _occurrences(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs again: the place, whether it is the key's first one, how often the key occurs."""
    order = np.argsort(keys)
    ranked = keys[order]
    start = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, np.int64)
    times = np.diff(np.append(start, len(ranked)))
    many = times > 1
    if not many.any():
        none = np.zeros(0, np.int64)
        return none, none.astype(bool), none
    at = places[order]
    first = np.minimum.reduceat(at, start)
    member = np.repeat(many, times)
    at, first, times = at[member], np.repeat(first, times)[member], np.repeat(times, times)[member]
    return at, at == first, times


def _measure_block(block: W.Block, rules: Rules) -> dict[str, np.ndarray]:
    n = block.last - block.first
    found = W.words(block)
    count = np.bincount(found.text, minlength=n)
    character = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(block.starts_character(), out=character[1:])
    size = character[found.ends] - character[found.starts]
    word_chars = np.bincount(found.text, weights=size, minlength=n).astype(np.int64)
    total = np.maximum(word_chars, 1)
    out = {"n_words": count, "word_chars": word_chars, "n_symbols": block.per_text(_SYMBOL[block.data])}

    line = W.lines(block)
    begun = np.zeros(len(block.data) + 1, np.int64)
    begun[found.starts + 1] = 1
    begun = np.cumsum(begun)
    full = np.flatnonzero(begun[line.ends] > begun[line.starts])
    salt = W.mix(np.arange(1, n + 1, dtype=np.uint64))
    keys = W.hash_spans(block.data, line.starts[full], line.ends[full]) ^ salt[line.text[full]]
    at, first, _ = _occurrences(keys, full)
    at = at[~first]
    n_dup = np.bincount(line.text[at], minlength=n)
    chars = character[line.ends[at]] - character[line.starts[at]]
    dup_chars = np.bincount(line.text[at], weights=chars, minlength=n)
    all_chars = character[block.offsets[1:]] - character[block.offsets[:-1]]
    out["n_dup_lines"] = n_dup
    out["dup_line_share"] = n_dup / np.maximum(np.bincount(line.text[full], minlength=n), 1)
    out["dup_line_char_share"] = dup_chars / np.maximum(all_chars, 1)

    hashed = W.hash_spans(block.data, found.starts, found.ends) if len(found.starts) else np.zeros(0, np.uint64)
    ends = np.cumsum(count)[found.text] if len(hashed) else np.zeros(0, np.int64)
    upto = np.append(0, np.cumsum(size))
    place, rolled = np.arange(len(hashed)), hashed
    long = count >= rules.long_words
    tops = {k: np.where(long, dict(rules.long_top)[k], v) for k, v in rules.top}
    shares = {k: np.where(long, dict(rules.long_repeated)[k], v) for k, v in rules.repeated}
    worst_top = np.zeros(n)
    out["n_repeat_words"] = np.zeros(n, np.int64)

    def covered(at: np.ndarray, length: int) -> np.ndarray:
        step = np.bincount(at, minlength=len(hashed) + 1) - np.bincount(at + length, minlength=len(hashed) + 1)
        return np.flatnonzero(np.cumsum(step)[:-1] > 0)

    passes = out["n_symbols"] <= rules.symbols * count
    passes &= out["dup_line_share"] <= np.where(long, rules.long_lines, rules.lines)
    passes &= out["dup_line_char_share"] <= np.where(long, rules.long_line_chars, rules.line_chars)
    for length in range(2, max([3, *tops, *shares]) + 1):
        inside = place + length <= ends[place]
        place, rolled = place[inside], rolled[inside]
        rolled = rolled * _ROLL + hashed[place + length - 1]
        at, first, times = _occurrences(W.mix(rolled) ^ salt[found.text[place]], place)
        if length == 3:
            out["n_repeat_words"] = np.bincount(found.text[covered(at, 3)], minlength=n)
        if length in tops:
            share = np.zeros(n)
            np.maximum.at(share, found.text[at], times * (upto[at + length] - upto[at]))
            share = share / total
            passes &= share <= tops[length]
            worst_top = np.maximum(worst_top, share)
        if length in shares:
            again = covered(at[~first], length)
            share = np.bincount(found.text[again], weights=size[again], minlength=n) / total
            out[f"repeated_{length}_share"] = share
            passes &= share <= shares[length]
        keep = np.isin(place, at, assume_unique=True) if len(at) else np.zeros(len(place), bool)
        place, rolled = place[keep], rolled[keep]
    out["top_gram_share"] = worst_top
    out["base_failed"] = (count < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_percent * count)
    out["kept"] = ~out["base_failed"] & passes
    return out


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _doubles(rules: Rules) -> list[str]:
    shares = [f"repeated_{length}_share" for length, _ in sorted(rules.repeated)]
    return ["dup_line_share", "dup_line_char_share", "top_gram_share", *shares]


def measure(docs: DataFrame, rules: Rules = Rules(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its counts, its shares, whether the base rule failed and whether the text is kept."""
    doubles = _doubles(rules)
    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join(
        [f"`{key}` {kind}", *(f"{c} long" for c in _LONGS), "base_failed boolean, kept boolean", *(f"{c} double" for c in doubles)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                got = _measure_block(block, rules)
                columns = [batch.column(0).slice(block.first, block.last - block.first)]
                columns += [pa.array(got[c], pa.int64()) for c in _LONGS]
                columns += [pa.array(got["base_failed"]), pa.array(got["kept"])]
                columns += [pa.array(got[c], pa.float64()) for c in doubles]
                yield pa.RecordBatch.from_arrays(columns, [key, *_LONGS, "base_failed", "kept", *doubles])

    return docs.select(key, text).mapInArrow(run, schema)


def keep(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(place)):
                passed = pa.array(_measure_block(block, rules)["kept"])
                yield batch.slice(block.first, block.last - block.first).filter(passed)

    return docs.mapInArrow(run, docs.schema)
