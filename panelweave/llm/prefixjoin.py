"""Near-duplicate groups: an n-gram Jaccard join with prefix, length, positional and suffix filters.

A text is the set of its distinct word 5-grams as 64-bit hashes, and a node is a distinct set (equal sets are one node,
so copies cost one row). Nodes link when ``100 * common >= percent * union``. The result names the group of every
document, so pairs inside a group need not all be looked at; every pair whose two texts are not yet known to be in
one group is.

1. One pass counts 5-grams in a table of ``COUNTERS`` counters (a fixed size), which orders them rare first.
2. The first ``n - ceil(n * t) + 1`` grams of each set in that order, its prefix, are dealt by gram, and grams that one
   node alone has fall away. The smaller of two sets that link has the first gram they share among its first
   ``n - ceil(2 * n * t / (1 + t)) + 1``, where it is called early; so grams that are early in no set fall away too, such as those of a
   passage that stands in many texts. Sets that link share one that is left. Grams whose counter is high are dealt by node as well.
3. Every node joins the cell of the node that it shares most prefix grams with, among the least nodes of its grams.
   A cell is cut into blocks of bounded size. In a block a search from node to node compares each node once with
   those not yet reached: by shared prefix grams and places left (positional bound), by gram counts in sixteenths of the
   hash range (suffix bound), and then in full.
4. Pairs that share a prefix gram but neither group nor block remain: first each node with its best partner outside,
   which ties the parts of a large group together, then all that are left and were not tried, joined by gram and band of sizes,
   early rows of the smaller set with all of the larger, under the length and positional filters, and verified once.
   No pair is left out and no partner is capped.

Set digests and gram hashes have 64 bits: n texts give about n * n / 2**65 false equal sets (0.03 at 10**9).

A null or empty text has no set and links with nothing. Ids are numbers. Documents without an id are in no group (``component_id`` null).
Rows repeated under one id are alike in group. Columns other than id and text are not read. Empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm import words as W
from panelweave.llm.components import components
from panelweave.workspace import materialise

#: Counters of the frequency table; 4 bytes each go to every executor.
COUNTERS = 1 << 20
_SLICES = 64
#: Grams of the sets that one block of a cell may hold.
BLOCK_GRAMS = 1 << 21
#: A gram counter is high from this, or from four times the mean.
HIGH = 1000
_ROLL = np.uint64(0xC2B2AE3D27D4EB4F)


def _grams(block: W.Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of each text of a block, sorted by text and hash: text numbers and hashes."""
    block = W.lower_ascii(block)
    found = W.words(block)
    if not len(found.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashed = W.hash_spans(block.data, found.starts, found.ends)
    rolled, text = hashed[: max(0, len(hashed) - size + 1)].copy(), found.text
    for k in range(1, size):
        rolled = rolled * _ROLL + hashed[k : k + len(rolled)]
    whole = text[: len(rolled)] == text[size - 1 :]
    text_of, grams = text[: len(rolled)][whole], rolled[whole]
    # Texts with fewer words: all of them, rolled with their number.
    count = np.bincount(text, minlength=block.last - block.first)
    first = np.cumsum(count) - count
    for n in range(1, size):
        at = np.flatnonzero(count == n)
        if len(at):
            short = np.full(len(at), n, np.uint64)
            for k in range(n):
                short = short * _ROLL + hashed[first[at] + k]
            text_of, grams = np.append(text_of, at), np.append(grams, short)
    grams = W.mix(grams)
    order = np.lexsort((grams, text_of))
    text_of, grams = text_of[order], grams[order]
    new = np.append(True, (grams[1:] != grams[:-1]) | (text_of[1:] != text_of[:-1]))
    return text_of[new], grams[new]


def _digest(text_of: np.ndarray, grams: np.ndarray, texts: int) -> np.ndarray:
    """A digest of each set, whatever the order; its sum wraps."""
    total = np.append(np.uint64(0), np.cumsum(W.mix(grams ^ np.uint64(0xA0761D6478BD642F))))
    cuts = np.searchsorted(text_of, np.arange(texts + 1))
    return W.mix(total[cuts[1:]] - total[cuts[:-1]]).view(np.int64)


_SETS = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])


def _count(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                n = block.last - block.first
                text_of, grams = _grams(block, size)
                np.add.at(counters, (grams % np.uint64(COUNTERS)).astype(np.int64), np.uint32(1))
                many = np.bincount(text_of, minlength=n)
                node = pa.array(_digest(text_of, grams, n), mask=many == 0)
                columns = [batch.column(0).slice(block.first, n).cast(pa.int64()), pa.array(many, pa.int64()), node, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=_SETS)
        if counters.any():
            parts = [p.astype("<u4").tobytes() for p in counters.reshape(_SLICES, -1)]
            empty = pa.nulls(_SLICES, pa.int64())
            columns = [empty, empty, empty, pa.array(range(_SLICES), pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_SETS)

    return run


def _frequencies(sets: DataFrame) -> np.ndarray:
    """The counters of all tasks added up: ``COUNTERS`` numbers come to the driver, whatever the number of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(packed, "<u8" if len(packed) > 4 * COUNTERS // _SLICES else "<u4").astype(np.uint64)
                total[i] = total[i] + counts if i in total else counts
        if total:
            parts = [total[i].astype("<u8").tobytes() for i in total]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    parts = sets.where("slice is not null").select("slice", "counts")
    added = parts.mapInArrow(run, "slice int, counts binary").repartition("slice").mapInArrow(run, "slice int, counts binary")
    out = np.zeros((_SLICES, COUNTERS // _SLICES), np.uint64)
    for row in added.collect():
        out[row["slice"]] = np.frombuffer(row["counts"], "<u8")
    return np.minimum(out.reshape(-1), 2**32 - 1).astype(np.uint32)


def _least_common(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """The least intersection with which sets of a and b grams link."""
    return -(-percent * (a + b) // (100 + percent))


def _early(size, place, percent: int):
    """Whether a set has enough grams from a place on to link with one that is not smaller; numbers, arrays or columns."""
    return (size - place) * (100 + percent) >= size * (2 * percent)


def _size() -> Column:
    return F.shiftright("at", 32)


def _place() -> Column:
    return F.col("at").bitwiseAND(0xFFFFFFFF)


def _prefixes(text_of: np.ndarray, grams: np.ndarray, texts: int, frequency: np.ndarray, percent: int):
    """Rare-first prefixes, text by text: text numbers, grams, places, and how often each gram is counted."""
    often = frequency[(grams % np.uint64(COUNTERS)).astype(np.int64)]
    order = np.lexsort((grams, often, text_of))
    size = np.bincount(text_of, minlength=texts)
    place = np.arange(len(grams)) - (np.cumsum(size) - size)[text_of]
    kept = place < (size - -(-percent * size // 100) + 1)[text_of]
    order = order[kept]
    return text_of[kept], grams[order], place[kept], often[order]


def _deal(sent, percent: int, size: int, high: int):
    names = ["gram", "node", "at", "often"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                n = block.last - block.first
                text_of, grams = _grams(block, size)
                nodes = _digest(text_of, grams, n)
                sizes = np.bincount(text_of, minlength=n)
                text, gram, place, often = _prefixes(text_of, grams, n, sent.value, percent)
                at = sizes[text] << 32 | place
                columns = [pa.array(gram.view(np.int64)), pa.array(nodes[text]), pa.array(at, pa.int64()), pa.array(often >= high)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _shared(percent: int):
    """From rows sorted by gram, early ones first, and node: each node once, without grams of one node or with late rows
    only. Rows of grams dealt by node stay. Holds one row between batches."""
    names = ["gram", "node", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_follows, held_late = None, False, False
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                rows = [np.append(h, r) for h, r in zip(held, rows)]
            gram, node = rows[0], rows[1]
            if not len(gram):
                continue
            new = np.append(True, (gram[1:] != gram[:-1]) | (node[1:] != node[:-1]))
            rows = [r[new] for r in rows]
            gram, at = rows[0], rows[2]
            like = gram[1:] == gram[:-1]
            follows = np.append(held_follows, like)
            # The first row of a gram tells whether any is early; that of the first gram may have passed before.
            late = ~_early(at >> 32, at & 0xFFFFFFFF, percent)
            late[0] = held_late if held_follows else late[0]
            late = late[np.maximum.accumulate(np.where(follows, 0, np.arange(len(gram))))]
            keep = (follows[:-1] | like) & ~late[:-1] | rows[3][:-1]
            yield pa.RecordBatch.from_arrays([pa.array(r[:-1][keep]) for r in rows[:3]], names)
            held, held_follows, held_late = [r[-1:] for r in rows], bool(follows[-1]), bool(late[-1])
        if held is not None and (held_follows and not held_late or held[3][0]):
            yield pa.RecordBatch.from_arrays([pa.array(r) for r in held[:3]], names)

    return run


class _Members:
    """The sets of a block of a cell, laid out for comparing one with many."""

    def __init__(self, sets: list[np.ndarray], prefixes: list[tuple[np.ndarray, np.ndarray]], percent: int):
        self.percent, self.sets = percent, sets
        self.size = np.array([len(s) for s in sets])
        self.prefix = [p[0] for p in prefixes]
        self.left = self.size - np.array([len(p) for p in self.prefix])
        last = np.lexsort((np.array([p[0][-1] for p in prefixes], np.uint64), np.array([p[1][-1] for p in prefixes])))
        self.last = np.empty(len(sets), np.int64)
        self.last[last] = np.arange(len(sets))
        self.early = self.size - _least_common(self.size, self.size, percent) + 1
        gram = np.concatenate(self.prefix)
        runs = np.array([len(p) for p in self.prefix])
        who = np.repeat(np.arange(len(sets)), runs)
        early = np.arange(len(gram)) - (np.cumsum(runs) - runs)[who] < self.early[who]
        order = np.argsort(gram)
        self.all = gram[order], who[order]
        order = order[early[order]]
        self.starts = gram[order], who[order]
        self.parts = np.stack([np.bincount((s >> np.uint64(60)).astype(np.int64), minlength=16) for s in sets])

    @staticmethod
    def _with(index: tuple[np.ndarray, np.ndarray], grams: np.ndarray) -> np.ndarray:
        """Members that an index has under any of the grams, once for each."""
        low = np.searchsorted(index[0], grams, "left")
        runs = np.searchsorted(index[0], grams, "right") - low
        return index[1][np.repeat(low - (np.cumsum(runs) - runs), runs) + np.arange(runs.sum())]

    def linked(self, x: int, open_: np.ndarray) -> np.ndarray:
        """Members marked in ``open_`` that link with ``x``."""
        near = np.zeros(len(self.sets), bool)
        # Of two that link, the first shared gram is early in the smaller one.
        near[self._with(self.all, self.prefix[x][: self.early[x]])] = True
        near[self._with(self.starts, self.prefix[x][self.early[x] :])] = True
        other = np.flatnonzero(near & open_)
        n, m = self.size[x], self.size[other]
        other = other[100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)]
        if not len(other):
            return other
        shared = np.bincount(self._with(self.all, self.prefix[x]), minlength=len(self.sets))
        need = _least_common(n, self.size[other], self.percent)
        rest = np.where(self.last[x] < self.last[other], self.left[x], self.left[other])
        fits = shared[other] + rest >= need
        other, need = other[fits], need[fits]
        fits = np.minimum(self.parts[x], self.parts[other]).sum(axis=1) >= need
        other, need = other[fits], need[fits]
        if not len(other):
            return other
        own = self.sets[x]
        grams = np.concatenate([self.sets[i] for i in other])
        place = np.minimum(np.searchsorted(own, grams), len(own) - 1)
        starts = np.append(0, np.cumsum(self.size[other])[:-1])
        return other[np.add.reduceat((own[place] == grams).astype(np.int64), starts) >= need]


def _groups(members: _Members, names: np.ndarray) -> np.ndarray:
    """The least name of each member's group, by a search over members not yet reached."""
    open_ = np.ones(len(names), bool)
    root = names.copy()
    for start in np.argsort(names):
        if open_[start]:
            open_[start] = False
            reached = [start]
            while reached and open_.any():
                found = members.linked(reached.pop(), open_)
                open_[found] = False
                root[found] = names[start]
                reached.extend(found.tolist())
    return root


def _sets_of(texts: pa.Array, frequency: np.ndarray, percent: int, size: int) -> Iterator[tuple]:
    """For each text: its digest, its sorted set and its prefix with counts."""
    for block in W.blocks(texts):
        n = block.last - block.first
        text_of, grams = _grams(block, size)
        nodes = _digest(text_of, grams, n)
        text, prefix, _, often = _prefixes(text_of, grams, n, frequency, percent)
        cuts, ends = np.searchsorted(text_of, np.arange(n + 1)), np.searchsorted(text, np.arange(n + 1))
        for i in range(n):
            yield nodes[i], grams[cuts[i] : cuts[i + 1]], (prefix[ends[i] : ends[i + 1]], often[ends[i] : ends[i + 1]])


def _search(sent, percent: int, size: int):
    """Rows (cell, block, node, text) sorted by cell and block: the group of each node within its block."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            cells, blocks, nodes = (batch.column(i).to_pylist() for i in range(3))
            for i, got in enumerate(_sets_of(batch.column(3), sent.value, percent, size)):
                # Another text under the id of this one.
                if got[0] == nodes[i]:
                    yield (cells[i], blocks[i]), got

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, roots = [], []
        for _, group in groupby(rows(batches), key=lambda r: r[0]):
            own = {int(g[0]): g for _, g in group}
            if len(own) > 1:
                names = np.array(list(own), np.int64)
                members = _Members([g[1] for g in own.values()], [g[2] for g in own.values()], percent)
                done.append(names)
                roots.append(_groups(members, names))
            if sum(map(len, done)) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (done, roots)], ["node", "root"])
                done, roots = [], []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (done, roots)], ["node", "root"])

    return run


def _verify(sent, percent: int, size: int):
    """Of rows (a, b, text of a, text of b), the names of those whose texts link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                left = list(_sets_of(part.column(2), sent.value, percent, size))
                right = list(_sets_of(part.column(3), sent.value, percent, size))
                links = [
                    len(x[1]) and len(y[1]) and bool(len(_Members([x[1], y[1]], [x[2], y[2]], percent).linked(0, np.array([False, True]))))
                    for x, y in zip(left, right)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(links, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, members: DataFrame, sent, percent: int, size: int) -> DataFrame:
    """Links between the groups of the pairs (``x``, ``y``, ``from``, ``to``) whose texts link."""
    texts = members.select("node", "text")
    rows = pairs.join(texts.select(F.col("node").alias("x"), F.col("text").alias("left")), "x")
    rows = rows.join(texts.select(F.col("node").alias("y"), F.col("text").alias("right")), "y")
    return rows.select("from", "to", "left", "right").mapInArrow(_verify(sent, percent, size), "a long, b long")


def _regroup(rows: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows under their new groups, and the old groups with the new ones."""
    moved = materialise(components(links), "moved")
    to = F.coalesce("root", "group").alias("group")
    renamed = moved.withColumnRenamed("node", "group")
    return rows.join(renamed, "group", "left").select("gram", "node", "at", "block", to), moved


def _undecided(rows: DataFrame) -> DataFrame:
    """Rows whose gram still stands in more than one group and block."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("group", "block")]
    grams = rows.groupBy("gram").agg(*ends).where("min_group != max_group and min_block != max_block")
    return rows.join(grams.select("gram"), "gram")


def _roots(spark: SparkSession, docs: DataFrame, sets: DataFrame, percent: int, size: int) -> DataFrame:
    """``node`` and the ``root`` of its group, for nodes that share a prefix gram with others."""
    frequency = _frequencies(sets)
    high = max(HIGH, 4 * int(frequency.mean()))
    sent = spark.sparkContext.broadcast(frequency)
    dealt = docs.select("id", "text").mapInArrow(_deal(sent, percent, size, high), "gram long, node long, at long, often boolean")
    spread = F.when(F.col("often"), F.pmod("node", F.lit(1024))).otherwise(0)
    early = _early(_size(), _place(), percent)
    dealt = dealt.repartition("gram", spread).sortWithinPartitions("gram", ~early, "node")
    rows = materialise(dealt.mapInArrow(_shared(percent), "gram long, node long, at long"), "prefixes").dropDuplicates(["gram", "node"])

    centres = rows.groupBy("gram").agg(F.min("node").alias("cell"), F.max(early).alias("early")).where("early").drop("early")
    votes = rows.join(centres, "gram").groupBy("node", "cell").agg(F.count("*").alias("votes"), F.max(F.shiftright("at", 32)).alias("n"))
    best = votes.groupBy("node").agg(F.max_by("cell", F.struct("votes", -F.col("cell"))).alias("cell"), F.max("n").alias("n"))
    cells = materialise(best, "cells")
    sizes = cells.groupBy("cell").agg(F.count("*").alias("nodes"), F.ceil(F.sum("n") / BLOCK_GRAMS).alias("blocks"))
    placed = cells.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    ids = sets.where("node is not null and id is not null").groupBy("node").agg(F.min("id").alias("id"))
    members = placed.join(ids, "node").join(docs.select("id", "text"), "id").select("cell", "block", "nodes", "node", "text")
    members = materialise(members, "members")
    near = members.where("nodes > 1").select("cell", "block", "node", "text").repartition("cell", "block").sortWithinPartitions("cell", "block")
    found = materialise(near.mapInArrow(_search(sent, percent, size), "node long, root long"), "groups")

    block = F.xxhash64("cell", "block").alias("block")
    known = placed.select("node", block).join(found, "node", "left").select("node", "block", F.coalesce("root", "node").alias("group"))
    left = materialise(_undecided(rows.join(known, "node")), "undecided")
    moves = []
    if not left.isEmpty():
        # Each node with the partner outside its group and block that it shares most grams with.
        sized = left.select("gram", "node", "group", "block", _size().alias("n"), _place().alias("place"))
        first = sized.groupBy("gram").agg(F.min(F.struct("node", "group", "block", "n", "place")).alias("c"))
        apart = (F.col("group") != F.col("c.group")) & (F.col("block") != F.col("c.block")) & _fits(F.col, lambda c: F.col(f"c.{c}"), percent)
        partner = F.struct("c.node", "c.group").alias("c")
        votes = sized.join(first, "gram").where(apart).groupBy("node", "group", partner).agg(F.count("*").alias("votes"))
        best = votes.groupBy("node", "group").agg(F.max_by("c", F.struct("votes", "c.node")).alias("c"))
        pairs = best.select(F.col("node").alias("x"), F.col("c.node").alias("y"), F.col("group").alias("from"), F.col("c.group").alias("to"))
        tried = materialise(pairs, "tried")
        left, moved = _regroup(left, _confirmed(tried, members, sent, percent, size))
        moves.append(moved)
        left = materialise(_undecided(left), "undecided")
        known_pairs = tried.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        pairs = materialise(_pairs(left, percent).join(known_pairs, ["x", "y"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            moves.append(materialise(components(_confirmed(pairs, members, sent, percent, size)), "moved"))
    roots = known.select("node", F.col("group").alias("root"))
    for moved in moves:
        moved = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
        roots = roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return roots


def _fits(a, b, percent: int) -> Column:
    """Length and positional filter for a gram that two sets share; ``a`` and ``b`` give their columns ``n`` and ``place``."""
    small, large = F.least(a("n"), b("n")), F.greatest(a("n"), b("n"))
    remaining = F.least(a("n") - a("place"), b("n") - b("place"))
    return (small * 100 >= large * percent) & (remaining * (100 + percent) >= (a("n") + b("n")) * percent)


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes in different groups and blocks that share a prefix gram and pass the length and positional filters.

    Rows of a gram meet by band of sizes, the smaller set's only where it is early."""
    rows = rows.select("gram", "node", "block", "group", _size().alias("n"), _place().alias("place"))
    width = math.log(max(100 / percent, 1.01))
    band = lambda n: F.floor(F.log(n) / width)
    largest = F.floor(F.col("n") * 100 / percent)
    a = rows.where(_early(F.col("n"), F.col("place"), percent)).withColumn("band", F.explode(F.sequence(band(F.col("n")), band(largest)))).alias("a")
    b = rows.withColumn("band", band(F.col("n"))).alias("b")
    on = (F.col("a.gram") == F.col("b.gram")) & (F.col("a.band") == F.col("b.band"))
    # Of equal sizes that fit, both are early.
    ahead = F.struct("a.n", "a.node") < F.struct("b.n", "b.node")
    apart = (F.col("a.group") != F.col("b.group")) & (F.col("a.block") != F.col("b.block"))
    fits = _fits(lambda c: F.col(f"a.{c}"), lambda c: F.col(f"b.{c}"), percent)
    swapped = F.col("a.node") > F.col("b.node")
    names = [F.least("a.node", "b.node").alias("x"), F.greatest("a.node", "b.node").alias("y")]
    names += [F.when(swapped, F.col(f"{p}.group")).otherwise(F.col(f"{q}.group")).alias(n) for p, q, n in (("b", "a", "from"), ("a", "b", "to"))]
    return a.join(b, on & ahead & apart & fits).select(*names).distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_shingles`` and ``component_id``, the smallest id that links reach."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n_shingles long, node long, slice int, counts binary"
    table = materialise(docs.mapInArrow(_count(size), schema), "sets")
    sets = table.where("slice is null")
    roots = materialise(_roots(spark, docs, table, percent, size), "roots")
    named = sets.select("id", "n_shingles", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = materialise(named.select("id", "n_shingles", "root"), "named")
    least = named.where("root is not null and id is not null").groupBy("root").agg(F.min("id").alias("least"))
    out = named.join(least, "root", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id")
    return out.select(F.col("id").alias(key), "n_shingles", component)


def keep_first(docs: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the least id of each group, with all columns, once; documents without an id stay.

    Rows of one id with different texts stay or go together."""
    found = near_duplicates(docs, percent, size, key, text)
    kept = found.where(F.col(key) == F.col("component_id")).select(key).distinct()
    known = docs.join(kept, key, "left_semi").select(*docs.columns)
    # Rows repeated under one id lie together already.
    return known.dropDuplicates([key, text]).union(docs.where(F.col(key).isNull()))
