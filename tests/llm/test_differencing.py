import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelweave.llm import differencing
from tests.llm.cases import documents, odd_documents, rows_of


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1000), min_size=4, max_size=4), max_size=40))
def test_sums_are_those_of_the_parts(vectors):
    sums, went = differencing.difference(vectors, 4)
    out = [0] * 4
    for vector, to in zip(vectors, went):
        assert sorted(to) == [0, 1, 2, 3]
        for part, place in enumerate(to):
            out[place] += vector[part]
    assert out == sums == sorted(sums, reverse=True)


def test_known_case():
    sums, _ = differencing.difference([[n, 0] for n in (8, 7, 6, 5, 4)], 2)
    assert sums == [16, 14]


def agree(docs, shards=4):
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        raw = (r["text"] or "").encode()
        want[r["doc_id"], len(raw) + 1, zlib.crc32(raw)] += 1
    got = rows_of(differencing.shard_by_bytes(docs, shards))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, places = defaultdict(list), defaultdict(set)
    for r in got:
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        places[r["text_crc32"], r["size"]].add(r["shard"])
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))
    return got, places


def test_odd_rows(spark):
    _, places = agree(odd_documents(spark))
    # Null and empty are groups of their own.
    assert all(len(p) == 1 for (_, size), p in places.items() if size > 1)


@pytest.mark.parametrize("chunk", [1 << 16, 7])
def test_documents(spark, monkeypatch, chunk):
    monkeypatch.setattr(differencing, "CHUNK", chunk)
    got, places = agree(documents(spark))
    assert all(len(p) == 1 for p in places.values())
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) - min(sums.values()) <= 0.02 * sum(sums.values())


def test_a_group_with_a_third_of_all_rows(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got, _ = agree(docs)
    own = {r["shard"] for r in got if r["size"] == 14 and r["doc_id"] % 3 == 0}
    assert len(own) == 1


@pytest.mark.parametrize("chunk, fan", [(1 << 16, 1 << 10), (50, 3)])
def test_shards_do_not_depend_on_partitions(spark, monkeypatch, chunk, fan):
    monkeypatch.setattr(differencing, "CHUNK", chunk)
    monkeypatch.setattr(differencing, "FAN", fan)
    docs = documents(spark)
    found = [sorted((r["doc_id"], r["shard"]) for r in rows_of(differencing.shard_by_bytes(d, 8))) for d in (docs, docs.repartition(5), docs.orderBy("n_chars").coalesce(2))]
    assert found[0] == found[1] == found[2]


def test_shards_of_a_plain_version(spark):
    """One chunk: the groups by size and digest, differenced at once."""
    docs = odd_documents(spark)
    groups = {}
    for r in docs.select("text").collect():
        raw = None if r["text"] is None else r["text"].encode()
        groups.setdefault(b"\x00" if raw is None else hashlib.sha256(raw).digest(), []).append(len(raw or b"") + 1)
    order = sorted(groups, key=lambda g: (-sum(groups[g]), g))
    _, went = differencing.difference([[sum(groups[g])] + [0] * 3 for g in order], 4)
    want = {g: w[0] for g, w in zip(order, went)}
    sizes = Counter()
    for g, shard in want.items():
        sizes[shard] += sum(groups[g])
    got = Counter()
    for r in rows_of(differencing.shard_by_bytes(docs, 4)):
        got[r["shard"]] += r["size"]
    # The chunks' parts go through two more differencings, which only name the shards anew.
    assert sorted(sizes.values()) == sorted(got.values())


def test_empty_table(spark):
    assert differencing.shard_by_bytes(documents(spark).limit(0), 4).count() == 0
