"""Shards of nearly equal bytes by Karmarkar-Karp differencing.

The partial partition with the largest spread is combined with the one next to it, the largest sum of one joined to the
smallest of the other, until one is left. This runs in three steps of one rule: over the groups of a chunk, over ``FAN``
chunks, and over these on the driver, which gets ``shards`` numbers for each ``FAN`` chunks and nothing of the groups.

A group is all rows of one text and stays whole, however large; its rows are counted by each task before the shuffle. Its chunk
follows from its digest and the number of groups, and in a chunk groups are taken by size and digest, so shards depend on the rows
alone, not on how they are partitioned or in which order they come. Groups of equal size are taken in the order of their digests.

Nulls are a group of their own, of size 1 a row, apart from that of empty texts. Rows that are alike in all columns are told apart by
slot only. A text of any length is hashed where it is read; an empty table gives no rows. Columns other than the two are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.workspace import materialise

#: Groups that one differencing run holds at a time, about; chunks are dealt by digest.
CHUNK = 1 << 16
#: Chunks that are combined by one task.
FAN = 1 << 10


def difference(vectors: Sequence[Sequence[int]], shards: int) -> tuple[list[int], list[list[int]]]:
    """The sums of the last partition, largest first, and for each vector the place where each of its parts went."""
    n = len(vectors)
    if not n:
        return [0] * shards, []
    sums, own, made = [], [], []
    for vector in vectors:
        order = sorted(range(shards), key=lambda i: -vector[i])
        sums.append([vector[i] for i in order])
        own.append(order)
    queue = [(s[-1] - s[0], i) for i, s in enumerate(sums)]
    heapq.heapify(queue)
    while len(queue) > 1:
        _, a = heapq.heappop(queue)
        _, b = heapq.heappop(queue)
        left, right = sums[a], sums[b]
        joined = [left[i] + right[-1 - i] for i in range(shards)]
        order = sorted(range(shards), key=lambda i: -joined[i])
        sums[a] = sums[b] = None  # type: ignore[call-overload]
        sums.append([joined[i] for i in order])
        made.append((a, b, order))
        heapq.heappush(queue, (sums[-1][-1] - sums[-1][0], len(sums) - 1))
    places: list = [None] * len(sums)
    places[-1] = list(range(shards))
    for node in range(len(sums) - 1, n - 1, -1):
        a, b, order = made[node - n]
        to = [0] * shards
        for new, old in enumerate(order):
            to[old] = places[node][new]
        places[a], places[b], places[node] = to, to[::-1], None
    went = []
    for i in range(n):
        out = [0] * shards
        for rank, part in enumerate(own[i]):
            out[part] = places[i][rank]
        went.append(out)
    return sums[-1], went


def _chunks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of each chunk, from frames sorted by chunk."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for chunk, part in frame.groupby("chunk", sort=False):
            if held and held[0]["chunk"].iloc[0] != chunk:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def _spread(shards: int):
    """Give each group a part of its chunk; after them, the size of each part (``group`` null)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in _chunks(frames):
            sums, went = difference([[size] + [0] * (shards - 1) for size in groups["size"].tolist()], shards)
            yield groups.assign(part=[w[0] for w in went])
            rows = [(None, size, groups["chunk"].iloc[0], part) for part, size in enumerate(sums)]
            yield pd.DataFrame(rows, columns=["group", "size", "chunk", "part"])

    return run


def _combine(shards: int):
    """For each part of the chunks of one fan, where it went and the size of what it is in there."""

    def run(chunks: pd.DataFrame) -> pd.DataFrame:
        wide = chunks.sort_values(["chunk", "part"])
        names = wide["chunk"].unique().tolist()
        sums, went = difference(wide["size"].to_numpy().reshape(-1, shards).tolist(), shards)
        rows = [(int(chunks["fan"].iloc[0]), c, p, to, sums[to]) for c, w in zip(names, went) for p, to in enumerate(w)]
        return pd.DataFrame(rows, columns=["fan", "chunk", "part", "at", "size"])

    return run


def shard_by_bytes(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``size`` (UTF-8 bytes and 1), ``text_crc32``, ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    plain = F.coalesce(F.col(text), F.lit(""))
    group = F.when(F.col(text).isNull(), F.lit(b"\x00")).otherwise(F.unhex(F.sha2(F.col(text), 256)))
    rows = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(plain) + 1).cast("long").alias("size"),
        F.crc32(F.encode(plain, "UTF-8")).alias("text_crc32"),
        group.alias("group"),
    )
    groups = materialise(rows.groupBy("group").agg(F.sum("size").alias("size")), "shard-groups")
    n_chunks = -(-groups.count() // CHUNK)
    if not n_chunks:
        return docs.sparkSession.createDataFrame([], T.StructType([docs.schema[key], *T.StructType.fromDDL("size long, text_crc32 long, shard int, slot long")]))
    # Digests are even, so chunks are; a bit string of 13 hexadecimal digits is a long.
    chunk = F.pmod(F.conv(F.substring(F.hex("group"), 1, 13), 16, 10).cast("long"), F.lit(n_chunks)).cast("int")
    dealt = groups.withColumn("chunk", chunk).repartition("chunk").sortWithinPartitions("chunk", F.desc("size"), "group")
    spread = materialise(dealt.mapInPandas(_spread(shards), "group binary, size long, chunk int, part int"), "shard-parts")

    fans = spread.where("group is null").select((F.floor(F.col("chunk") / FAN)).cast("int").alias("fan"), "chunk", "part", "size")
    combined = materialise(fans.groupBy("fan").applyInPandas(_combine(shards), "fan int, chunk int, part int, at int, size long"), "shard-fans")
    # One sum for each fan and part: as many numbers as shards for some 64 million groups.
    sums: dict[int, list[int]] = {}
    for r in combined.select("fan", "at", "size").distinct().collect():
        sums.setdefault(r["fan"], [0] * shards)[r["at"]] = r["size"]
    names = sorted(sums)
    _, went = difference([sums[f] for f in names], shards)
    to_shard = spark.createDataFrame([(f, p, went[i][p]) for i, f in enumerate(names) for p in range(shards)], "fan int, at int, shard int")
    parts = combined.select("fan", "chunk", "part", "at").join(F.broadcast(to_shard), ["fan", "at"]).select("chunk", "part", "shard")
    placed = spread.where("group is not null").join(parts, ["chunk", "part"])
    dealt = materialise(rows.join(placed.select("group", "shard"), "group").drop("group"), "shard-rows")

    # Numbers within a shard: within buckets of it, after the rows of the buckets before.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "bucket").orderBy("id", "text_crc32", "size")
    numbered = dealt.withColumn("rank", F.row_number().over(inside)).join(F.broadcast(base), ["shard", "bucket"])
    return numbered.select(F.col("id").alias(key), "size", "text_crc32", "shard", (F.col("base") + F.col("rank") - 1).alias("slot"))
