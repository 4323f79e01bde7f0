import random
from collections import defaultdict

import pyarrow as pa
import pytest

from panelweave.llm import prefixjoin
from panelweave.llm.components import components
from tests.llm.cases import documents, lower, odd_documents, words


def plain_sets(rows):
    out = []
    for i, text in rows:
        found = words(lower(text))
        grams = {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()
        out.append((i, frozenset(grams)))
    return out


def plain(rows):
    sets = plain_sets(rows)
    distinct = list({s for i, s in sets if s and i is not None})
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    # Every pair, so this is for small tables.
    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if 80 * max(len(a), len(b)) <= 100 * min(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= 80 * (len(a) + len(b) - common):
                    parent[root(a)] = root(b)
    least = defaultdict(lambda: float("inf"))
    for i, s in sets:
        if s and i is not None:
            least[root(s)] = min(least[root(s)], i)
    return sorted((repr(i), len(s), None if i is None else least[root(s)] if s else i) for i, s in sets)


def found(docs):
    return sorted((repr(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in prefixjoin.near_duplicates(docs).collect())


def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", [odd_documents, documents])
def test_groups(spark, which):
    docs = which(spark)
    assert found(docs) == plain(rows(docs))


def edited(rng, base, share):
    return " ".join(f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in base)


def test_large_near_group(spark, monkeypatch):
    """Copies of a few texts with random edits: many links, stragglers, and cells cut into small blocks."""
    monkeypatch.setattr(prefixjoin, "BLOCK_GRAMS", 3000)
    rng = random.Random(5)
    texts = []
    for b in range(3):
        base = [f"b{b}x{k}" for k in range(120)]
        texts += [edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.03])) for _ in range(120)]
    shared = " ".join(f"common{k}" for k in range(60))
    texts += [shared + " " + " ".join(f"own{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(150)]
    rng.shuffle(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(docs) == plain(rows(docs))


def passage_texts(rng, many):
    """Texts with one passage of 100 words and 20 words of their own: every pair shares 96 of 136 distinct grams, and none links."""
    passage = " ".join(f"common{k}" for k in range(100))
    return [" ".join(f"own{rng.randrange(10**9)}" for _ in range(20)) + " " + passage for _ in range(many)]


def test_common_passage_makes_no_pairs(spark, monkeypatch):
    """Grams that are late in every prefix fall away before any two texts meet."""
    tried = []
    confirmed = prefixjoin._confirmed
    monkeypatch.setattr(prefixjoin, "_confirmed", lambda pairs, *rest: tried.append(pairs.count()) or confirmed(pairs, *rest))
    monkeypatch.setattr(prefixjoin, "BLOCK_GRAMS", 2000)
    texts = passage_texts(random.Random(9), 300)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(docs) == sorted((repr(i), 116, i) for i in range(300))
    assert sum(tried) == 0


def test_pairs_by_bands_are_those_of_the_filters(spark):
    """The join by bands and early rows gives what the filters give over all pairs that can be the first shared gram."""
    rng = random.Random(3)
    rows = []
    for node in range(120):
        n = rng.randrange(1, 60)
        prefix = n - -(-80 * n // 100) + 1
        rows += [(gram, node, n << 32 | rng.randrange(prefix), rng.randrange(3), node % 17) for gram in range(4)]
    got = prefixjoin._pairs(spark.createDataFrame(rows, "gram long, node long, at long, block long, group long"), 80)
    want = set()
    for g, a, at, block, group in rows:
        for h, b, bt, other, to in rows:
            n, m, left = at >> 32, bt >> 32, min((at >> 32) - (at & 0xFFFFFFFF), (bt >> 32) - (bt & 0xFFFFFFFF))
            if g == h and a < b and group != to and block != other and 100 * min(n, m) >= 80 * max(n, m) and left * 180 >= (n + m) * 80:
                want.add((a, b, group, to))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100


@pytest.mark.parametrize("rows_in_batch", [1, 2, 7, 1000])
def test_shared_rows_whatever_the_batches(rows_in_batch):
    rng = random.Random(4)
    rows = set()
    for gram in range(60):
        for node in rng.sample(range(30), rng.randrange(1, 6)):
            rows.add((gram, node, 40 << 32 | rng.choice([0, 3, 6, 7, 8] if gram % 2 else [6, 7, 8]), gram % 10 == 0))
    early = {g: [(at & 0xFFFFFFFF) * 180 <= 40 * 20 for h, _, at, _ in rows if h == g] for g in range(60)}
    want = sorted(r[:3] for r in rows if r[3] or len(early[r[0]]) > 1 and any(early[r[0]]))
    repeated = sorted([*rows, *rng.sample(sorted(rows), 40)], key=lambda r: (r[0], (r[2] & 0xFFFFFFFF) * 180 > 40 * 20, r[1]))
    table = pa.table({n: [r[i] for r in repeated] for i, n in enumerate(["gram", "node", "at", "often"])})
    got = prefixjoin._shared(80)(table.to_batches(rows_in_batch))
    assert sorted(tuple(r.values()) for b in got for r in b.to_pylist()) == want and 0 < len(want) < len(rows)


def test_no_pair_is_verified_twice(spark, monkeypatch):
    """Across blocks, texts that nearly link are tried once."""
    seen = []
    confirmed = prefixjoin._confirmed
    monkeypatch.setattr(
        prefixjoin, "_confirmed", lambda pairs, *rest: seen.extend((min(p), max(p)) for p in pairs.select("x", "y").collect()) or confirmed(pairs, *rest)
    )
    monkeypatch.setattr(prefixjoin, "BLOCK_GRAMS", 300)
    rng = random.Random(11)
    base = [f"b{k}" for k in range(100)]
    texts = [edited(rng, base, 0.03) for _ in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert found(docs) == plain(rows(docs))
    assert seen and len(seen) == len({*seen})


def test_every_gram_is_high(spark, monkeypatch):
    """Grams dealt by node as well lose nothing."""
    monkeypatch.setattr(prefixjoin, "HIGH", 0)
    docs = odd_documents(spark)
    assert found(docs) == plain(rows(docs))


def test_empty_table(spark):
    assert prefixjoin.near_duplicates(documents(spark).limit(0)).count() == 0


def test_keep_first(spark):
    docs = documents(spark).unionByName(odd_documents(spark), allowMissingColumns=True)
    kept = prefixjoin.keep_first(docs)
    assert kept.columns == docs.columns
    groups = prefixjoin.near_duplicates(docs).where("doc_id is not null")
    got = [r[0] for r in kept.select("doc_id").where("doc_id is not null").collect()]
    assert set(got) == {r[0] for r in groups.select("component_id").distinct().collect()}
    assert kept.where("doc_id is null").count() == 2


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 180)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {n: n for pair in links for n in pair}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    assert got == {n: root(n) for n in parent if root(n) != n}
