import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelweave.llm import merkle, queries
from tests.compare import connect, difference
from tests.llm.cases import documents

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place string, digest string, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def beside(levels, place):
    found = []
    for level in levels[:-1]:
        run = level[place // 2 * 2 : place // 2 * 2 + 2]
        found.append((place % 2, run[1 - place % 2] if len(run) > 1 else None))
        place //= 2
    return found


def plain(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    out, trees = [], {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in by_lang[lang]])
    top = tree([trees[x][-1][0] for x in langs])
    for k, lang in enumerate(langs):
        for i, r in enumerate(by_lang[lang]):
            path = beside(trees[lang], i) + beside(top, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            digest = leaf([*r[:3], r[3] + 1, r[4]]) if changed else leaf(r)
            for side, sibling in path:
                digest = h(*([digest] if sibling is None else [sibling, digest] if side else [digest, sibling]))
            proof = h(*[s for _, s in path if s])
            out.append((str(r[0]), leaf(r), trees[lang][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out)


def agree(spark, rows, parts=3):
    docs = spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], SCHEMA).repartition(parts)
    found = merkle.manifest(docs, merkle.seventh(F.col("doc_id")))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((str(r[0]), *r[1:]) for r in found.collect())
    assert got == plain(rows)
    return got


def rows_of(n, lang="en"):
    return [(i, f"s{i % 3}", lang, i * 7, f"text {i} é") for i in range(n)]


ODD = [
    (None, None, None, None, None), (None, "s", None, 3, ""), (1, "s", "en", 5, "é" * 10), (1, "s", "en", 5, "é" * 10), (1, "t", "en", None, "x"),
    (7, "s", "", 1, " "), (2**60 + 1, "s", "en", 2**62, "big"), (2**60 + 2, "s", "é", 0, "9:x"), (-5, "s", "z", -1, "w " * 200_000), (3, "s", "Z", 9, None),
]


def test_odd_rows(spark):
    agree(spark, ODD)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 9])
def test_small_trees(spark, n):
    agree(spark, rows_of(n))


@pytest.mark.parametrize("step", [1, 2, 3])
def test_many_sweeps(spark, monkeypatch, step):
    """Stretches so short that a tree takes several sweeps, trees of several heights, and more languages than a stretch."""
    monkeypatch.setattr(merkle, "STEP", step)
    rows = rows_of(70) + [(100 + i, "s", f"l{i % 11}", i, "t") for i in range(40)] + [(1000, "s", "one", 1, "t")]
    got = agree(spark, rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_one_row_a_third_of_the_table(spark):
    agree(spark, rows_of(40) + [(3, "s", "en", 1, "same")] * 20)


def test_largest_long(spark):
    i = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 0)
    agree(spark, [(i, "s", "en", 2**63 - 1, "t"), (i + 1, "s", "en", 1, "t")])


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70))
def test_sweeps_over_a_stretch(n):
    leaves = [h(str(i)) for i in range(n)]
    want = tree(leaves)
    made = merkle.forward(leaves, len(want) - 1)
    assert made == want
    paths = list(merkle.backward(made, ["above"]))[::-1]
    assert paths == [[s for _, s in beside(want, i) if s] + ["above"] for i in range(n)]
    assert all(merkle.fold(leaves[i], i, n, paths[i]) == want[-1][0] for i in range(n))


def test_nothing_tampered_is_verified(spark):
    assert merkle.manifest(documents(spark)).where("not verified").count() == 0


def test_empty_table(spark):
    assert merkle.manifest(documents(spark).limit(0)).count() == 0


def test_query(spark, sf_dir="/root/testdata/sf0.001"):
    got = queries.op13_timeforward(spark, sf_dir)
    assert difference(got, connect(sf_dir), queries.ORACLE["op13_timeforward"]) is None
