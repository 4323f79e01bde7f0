"""A Merkle manifest of a data set, by time-forward processing.

Nodes are labelled by the place of their last leaf and their level, so a child comes before its parent. A sweep over the leaves in
order delivers each digest to its parent through a priority queue ordered by label; the same sweep backwards delivers
to each node the digests beside the path above it, and so to each leaf its proof. The queue of a task holds the open path only. It is made external
in runs: the leaves of a tree are cut into stretches of ``2**STEP`` places, each is swept by one task, and the top nodes of
the stretches, written to the shared folder, are the leaves of the next sweep. Thus a tree of any size is a few sweeps, each over
4096 times fewer nodes than the one before, and no task holds more than a stretch.

Texts are hashed where they are read and not moved. Leaves are numbered from a range sort of (tree, id, digest) and the counts of the
ranges, so one language with most of the rows is many ranges. The trees of the languages end in one node each, and these are the
leaves of the last tree, which goes the same way; no number of languages is assumed.

A null is hashed as ``-``. A null id stands before all others and is not tampered with; equal ids are ordered by their leaf, and
rows alike in all columns are leaves of their own. Empty and very long texts are texts like any other. An empty table gives no
rows. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelweave.workspace import materialise

#: Levels of a tree that one sweep climbs: a stretch has ``2**STEP`` leaves.
STEP = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(columns: Sequence[Column]) -> Column:
    """SHA-256 over the values: ``-`` if null, else the count of UTF-8 bytes, ``:`` and the value."""
    parts = []
    for c in columns:
        value = F.encode(c.cast("string"), "UTF-8")
        counted = F.concat(F.octet_length(value).cast("string"), F.lit(":")).cast("binary")
        parts.append(F.when(c.isNull(), F.lit(b"-")).otherwise(F.concat(counted, value)))
    return F.sha2(F.concat(*parts), 256)


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def forward(leaves: Sequence[str], levels: int) -> list[list[str]]:
    """All levels of a stretch, from its leaves up, by a queue of (label, digest) messages.

    A label is (place of the last leaf below, level); a parent's label follows those of its children. A message waits
    until the sweep has reached its label.
    """
    made: list[list[str]] = [[] for _ in range(levels + 1)]
    queue: list[tuple[int, int, int, str]] = []
    last = len(leaves) - 1

    def send(level: int, index: int, digest: str) -> None:
        made[level].append(digest)
        if level < levels:
            up = level + 1
            closes = min((((index >> 1) + 1) << up) - 1, last)
            heapq.heappush(queue, (closes, up, index, digest))

    for place, leaf in enumerate(leaves):
        send(0, place, leaf)
        while queue and queue[0][0] <= place:
            closes, level, index, digest = heapq.heappop(queue)
            run = [digest]
            if queue and queue[0][:2] == (closes, level):
                run.append(heapq.heappop(queue)[3])
            send(level, index >> 1, _hash(run))
    return made


def backward(made: list[list[str]], above: Sequence[str]) -> Iterator[list[str]]:
    """The digests beside the path of each leaf, from its own sibling up, given those ``above`` the stretch; last leaf first.

    The sweep runs in the reverse order of labels; on its way down a node hands its children what stands above it.
    """
    levels = len(made) - 1
    open_paths: list[tuple[int, int, list[str]]] = [(levels, i, list(above)) for i in range(len(made[levels]))]
    while open_paths:
        # The right child is handled first, so what waits is one node a level.
        level, index, path = open_paths.pop()
        if not level:
            yield path
            continue
        below = made[level - 1]
        left, right = 2 * index, 2 * index + 1
        if right < len(below):
            open_paths.append((level - 1, left, [below[right], *path]))
            open_paths.append((level - 1, right, [below[left], *path]))
        else:
            open_paths.append((level - 1, left, path))


def fold(leaf: str, place: int, n: int, beside: Sequence[str]) -> str:
    """The root that follows from a leaf at ``place`` of ``n`` and the digests beside its path; ``beside`` may go on past this tree."""
    at = iter(beside)
    while n > 1:
        if place ^ 1 < n:
            sibling = next(at)
            leaf = _hash([sibling, leaf] if place & 1 else [leaf, sibling])
        else:
            leaf = _hash([leaf])
        place, n = place >> 1, (n + 1) >> 1
    return leaf


def _levels(size: Column, done: int) -> Column:
    """Levels to climb in a sweep over a tree of ``size`` leaves of which ``done`` levels are done: to the top, at most ``STEP``."""
    height = F.length(F.bin(size - 1)) - F.when(size == 1, 1).otherwise(0)
    return F.greatest(F.least(height - done, F.lit(STEP)), F.lit(0)).cast("int")


def numbered(nodes: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``nodes`` with ``place`` (from 0, in ``order``) and ``size`` (leaves) within each tree."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order)
    # The order of rows within a range is kept by the number of each row in its file.
    kept = materialise(ranged.withColumn("range", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id()), "ranges")
    counts = kept.groupBy(tree, "range").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    # One row for each tree and range.
    whole = Window.partitionBy(tree)
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        F.col(tree).alias("base_tree"), F.col("range").alias("base_range"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"),
    )
    joined = kept.join(base, (F.col(tree) == F.col("base_tree")) & (F.col("range") == F.col("base_range")))
    return joined.select(*nodes.columns, (F.col("nth") + F.col("shift")).alias("place"), "size")


def _stretches(df: DataFrame, *order: str) -> DataFrame:
    """Rows of a stretch together, in order."""
    return df.repartition("tree", "stretch").sortWithinPartitions("tree", "stretch", *order)


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each stretch, from frames sorted by tree and stretch."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        new = ((frame["tree"] != frame["tree"].shift()) | (frame["stretch"] != frame["stretch"].shift())).to_numpy()
        cuts = [*new.nonzero()[0].tolist(), len(frame)]
        for start, end in zip(cuts, cuts[1:]):
            part = frame.iloc[start:end]
            if held and tuple(held[0][["tree", "stretch"]].iloc[0]) != tuple(part[["tree", "stretch"]].iloc[0]):
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def _climb(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _groups(frames):
        made = forward(rows["digest"].tolist(), int(rows["levels"].iloc[0]))
        top = rows.iloc[:1]
        yield pd.DataFrame({"tree": top["tree"], "place": top["stretch"], "size": top["size"], "digest": [made[-1][0]]})


def tops(nodes: DataFrame) -> list[DataFrame]:
    """The tables of all sweeps over ``nodes`` (tree, place, size, digest): the nodes themselves, then the tops of their stretches.

    The last table has one row for each tree. Sweeps are needed until the largest tree is done.
    """
    largest = nodes.agg(F.max("size")).first()[0] or 0
    tables, done = [nodes], 0
    while True:
        cut = tables[-1].withColumn("levels", _levels(F.col("size"), done)).withColumn("stretch", F.shiftright("place", STEP))
        swept = _stretches(cut, "place").mapInPandas(_climb, "tree string, place long, size long, digest string")
        tables.append(materialise(swept, "stretch-tops"))
        done += STEP
        if largest <= 1 << done:
            return tables


def _path(digests: str) -> list[str]:
    return [digests[i : i + 64] for i in range(0, len(digests), 64)]


def _beside(rows: pd.DataFrame) -> list[list[str]]:
    """For each node of a stretch, the digests beside its path up to the root; the row from above comes first."""
    made = forward(rows["digest"].iloc[1:].tolist(), int(rows["levels"].iloc[0]))
    return list(backward(made, _path(rows["beside"].iloc[0])))[::-1]


def _descend(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _groups(frames):
        below = rows.iloc[1:]
        yield pd.DataFrame({"tree": below["tree"], "place": below["place"], "beside": ["".join(p) for p in _beside(rows)]})


def _with_heads(nodes: DataFrame, tops: DataFrame, found: DataFrame, done: int, *carried: str) -> DataFrame:
    """Stretches of ``nodes``, each after one row from above: ``beside`` and ``carried`` of ``found``, ``levels`` of the stretch."""
    sizes = tops.select("tree", F.col("place").alias("stretch"), _levels(F.col("size"), done).alias("levels"))
    heads = found.withColumnRenamed("place", "stretch").join(sizes, ["tree", "stretch"])
    heads = heads.select("tree", "stretch", F.lit(-1).cast("long").alias("place"), "beside", "levels", *carried)
    own = nodes.withColumn("stretch", F.shiftright("place", STEP))
    return _stretches(own.unionByName(heads, allowMissingColumns=True), "place")


def beside_paths(tables: list[DataFrame], above: DataFrame, down_to: int = 0) -> DataFrame:
    """(tree, place, beside) of the nodes of table ``down_to``: the reversed sweeps, from ``above`` (tree, beside: what stands above each tree)."""
    found = above.select("tree", F.lit(0).cast("long").alias("place"), "beside")
    for k in range(len(tables) - 2, down_to - 1, -1):
        rows = _with_heads(tables[k].select("tree", "place", "digest"), tables[k + 1], found, k * STEP)
        found = materialise(rows.mapInPandas(_descend, "tree string, place long, beside string"), "paths")
    return found


def _siblings(place: int, n: int) -> int:
    """How many nodes on the way from a leaf to the top have a sibling."""
    found = 0
    while n > 1:
        found += place ^ 1 < n
        place, n = place >> 1, (n + 1) >> 1
    return found


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in _groups(frames):
        head, leaves = rows.iloc[0], rows.iloc[1:]
        root, top_place, top_size = head["root"], int(head["top_place"]), int(head["top_size"])
        proofs, folded = [], []
        for path, leaf, place, size in zip(_beside(rows), leaves["start"], leaves["place"].tolist(), leaves["size"].tolist()):
            proofs.append(_hash(path))
            # Inside its own tree first, then in the tree of trees.
            own = _siblings(int(place), int(size))
            folded.append(fold(fold(leaf, int(place), int(size), path[:own]), top_place, top_size, path[own:]))
        yield pd.DataFrame({
            "doc_id": leaves["doc_id"], "leaf": leaves["digest"], "subroot": head["subroot"], "root": root,
            "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded],
        })


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified`` of every row.

    Where ``tampered`` (over the columns of ``FIELDS``) holds, the root is folded from a leaf with 1 added to ``n_chars``; the rest
    of the tree is as it is.
    """
    named = docs.select(*FIELDS)
    columns = [F.col(c) for c in FIELDS]
    changed = [F.col(c).cast("decimal(38,0)") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    own = digest_of(columns)
    start = own if tampered is None else F.when(F.coalesce(tampered, F.lit(False)), digest_of(changed)).otherwise(own)
    # A language's name after "=", so that null, the empty name, comes first; strings are ordered by their bytes.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    hashed = named.select("doc_id", tree.alias("tree"), own.alias("digest"), start.alias("start"), F.monotonically_increasing_id().alias("row"))
    hashed = materialise(hashed, "leaves")
    leaves = materialise(numbered(hashed, "tree", ["doc_id", "digest", "row"]).drop("row"), "numbered-leaves")

    below = tops(leaves.select("tree", "place", "size", "digest"))
    subroots = below[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top_leaves = materialise(numbered(subroots, "tree", ["name"]), "subroots")
    above = tops(top_leaves.select("tree", "place", "size", "digest"))
    top_paths = beside_paths(above, above[-1].select("tree", F.lit("").alias("beside"))).select("place", "beside")
    trees = top_leaves.join(top_paths, "place").select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), above[-1].select("digest").scalar().alias("root"),
        "beside", F.col("place").alias("top_place"), F.col("size").alias("top_size"),
    )
    trees = materialise(trees, "trees")

    heads = beside_paths(below, trees, down_to=1).join(trees.drop("beside"), "tree")
    # Ids travel as text: with the rows from above among them, pandas would make numbers of them that round.
    rows = _with_heads(leaves.withColumn("doc_id", F.col("doc_id").cast("string")), below[1], heads, 0, "subroot", "root", "top_place", "top_size")
    found = rows.mapInPandas(_verify, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def seventh(key: Column) -> Column:
    """Whether 7 divides the unsigned CRC-32 of the decimal id."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 7 == 0
