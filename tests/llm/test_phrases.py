import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from panelweave.llm import phrases
from panelweave.llm import words as W
from tests.llm.cases import documents, odd_documents


def toss(before, own):
    place = 0
    while (before ^ own) >> place & 1 == 0:
        place += 1
    return 2 * place + (own >> place & 1)


def plain_cuts(names):
    """Where phrases begin, one name after the other."""
    at = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
    label, size = [names[i] for i in at], 256
    if any(n > 255 for n in names):
        label, size = [label[0] & 1, *(toss(a, b) for a, b in zip(label, label[1:]))], 128
    while size > 8:
        label = [label[0] & 1, *(toss(a, b) for a, b in zip(label, label[1:]))]
        size = 16 if size > 16 else 8
    out = []
    for i in range(len(at)):
        right = label[i + 1] if i + 1 < len(at) else -1
        if i == 0 or (label[i] > label[i - 1] and label[i] > right):
            out.append(at[i])
    return out


@pytest.mark.parametrize("names", [list(b"a"), list(b"aaaa"), list("abracadabra mississippi ü".encode()), [random.Random(3).randrange(2**64) for _ in range(300)] + [5, 5, 5, 2**63]])
def test_cuts(names):
    kind = np.uint8 if max(names) < 256 else np.uint64
    first = np.zeros(len(names), bool)
    first[0] = True
    assert phrases.cuts(np.array(names, kind), first).tolist() == plain_cuts(names)


def names_of(text):
    return [phrases.phrase_names(b)[0].tolist() for b in W.blocks(pa.array([text]))][0]


def test_equal_substrings_share_interior_names():
    rng = random.Random(7)
    inner = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    a, b = names_of("xyz" + inner + "end"), names_of("another beginning " + inner + " and another end")
    inside = names_of(inner)[6:-6]
    assert len(inside) > 50
    for other in (a, b):
        assert any(other[i : i + len(inside)] == inside for i in range(len(other)))


def test_texts_of_a_block_do_not_touch():
    texts = ["aab", "baa", "", "a", "tail of aab", "baa" * 50]
    together = [phrases.phrase_names(b) for b in W.blocks(pa.array(texts))][0]
    for i, text in enumerate(texts):
        assert together[0][together[1] == i].tolist() == (names_of(text) if text else [])


def plain(rows):
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] or "")
    rows = sorted(rows, key=key)
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = phrases.fingerprints(pa.array([text, changed, following]))
        like = phrases.likeness(prints[[0, 0]], prints[1:]).tolist()
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((repr(i), len(text), digest, prints[0].tobytes().hex(), prints[1].tobytes().hex(), *like))
    return sorted(out)


@pytest.mark.parametrize("which", [documents, odd_documents])
def test_with_next(spark, which):
    docs = which(spark)
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = sorted((repr(r[0]), *r[1:]) for r in phrases.fingerprint_with_next(docs).collect())
    assert got == want


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    docs = documents(spark).orderBy("doc_id").limit(n)
    want = plain([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sorted((repr(r[0]), *r[1:]) for r in phrases.fingerprint_with_next(docs).collect()) == want


def test_likeness_follows_the_overlap():
    rng = random.Random(2)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(2000))
    near = base.replace("w1", "v1", 5)
    other = " ".join(f"w{rng.randrange(5000)}" for _ in range(2000))
    prints = phrases.fingerprints(pa.array([base, near, other, base, "", ""]))
    assert phrases.likeness(prints[:1], prints[1:2])[0] > 0.8
    assert phrases.likeness(prints[:1], prints[2:3])[0] < 0.2
    assert phrases.likeness(prints[[0, 4]], prints[[3, 5]]).tolist() == [1, 1]


def test_equal_texts(spark):
    prints = {}
    for r in phrases.fingerprint(documents(spark).unionByName(odd_documents(spark), allowMissingColumns=True)).collect():
        prints.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert prints[12] and all(len(p) <= 3 for p in prints.values())
