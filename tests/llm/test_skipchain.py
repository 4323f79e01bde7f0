import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelweave.llm import skipchain
from tests.llm.cases import documents, odd_documents

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == 1:
        return all(int(p) <= 255 for p in found.split("."))
    if kind == 2:
        doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plain_base(text):
    return [(k, *m.span()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text) if holds(k, m[0])]


@settings(max_examples=800, deadline=None)
@given(st.text("ab@.-+0159 (\n", max_size=60) | st.from_regex("(" + "|".join(PLAIN) + "|[ @.+])*"))
def test_base(text):
    assert skipchain.base_spans(text) == plain_base(text)


def test_base_is_quick_on_long_runs():
    for run in ("a", "1", "1.", "a@", "+1", "1 ", "@", "%."):
        skipchain.base_spans(run * 200_000)
        skipchain.graph([run * 200_000], [[]])


def test_chain_is_exact():
    """On a chain without ties the messages give the exact marginals."""
    rng = np.random.default_rng(4)
    field = skipchain.Field(rng.normal(size=(skipchain._BUCKETS, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    g = skipchain.graph(["1a 22b 3@c 4-d"], [[]])
    assert len(g.chain) == 3 and not len(g.ties)
    local = field.unary[g.features[:, 0]] + field.unary[g.features[:, 1]]
    total = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        weight = np.exp(sum(local[i, k] for i, k in enumerate(labels)) + sum(field.chain[a, b] for a, b in zip(labels, labels[1:])))
        for i, k in enumerate(labels):
            total[i, k] += weight
    assert np.allclose(skipchain.beliefs(field, g), total / total.sum(axis=1, keepdims=True), atol=2e-3)


def test_one_tie_is_exact():
    rng = np.random.default_rng(5)
    tie = rng.normal(size=(5, 5))
    field = skipchain.Field(rng.normal(size=(skipchain._BUCKETS, 5)), rng.normal(size=(5, 5)), tie + tie.T)
    g = skipchain.graph(["12345 and then 12345"], [[]])
    assert g.ties.tolist() == [[0, 1]] and not len(g.chain)
    local = field.unary[g.features[:, 0]] + field.unary[g.features[:, 1]]
    joint = np.exp(local[0][:, None] + local[1][None, :] + field.tie)
    want = np.stack([joint.sum(axis=1), joint.sum(axis=0)]) / joint.sum()
    assert np.allclose(skipchain.beliefs(field, g), want, atol=2e-3)


PHONES = ["call +1 (968) 555-{:04d} now", "fax +49 30 5550{:03d} here", "mail a.b{}@mail.example.com today", "host 10.2.3.{} up", "version {}.0 of it"]


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i, PHONES[i % 5].format(i % 200)) for i in range(2000)]
    return skipchain.train(spark.createDataFrame(rows, "doc_id long, text string"))


def test_a_repeated_number_takes_the_label_of_its_like(spark, trained):
    texts = ["call +1 (968) 555-2485 now, that is 555-2485 again", "only 555-2485 here", "version 2.0 and 2.0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in skipchain.find(docs, trained).collect()}
    assert found[0]["n_phone"] == 1 and found[0]["n_added"] >= 1
    assert "phone:36:44" in found[0]["spans"]
    assert found[2]["n_added"] == 0


@pytest.mark.parametrize("which", [documents, odd_documents])
def test_find_keeps_the_base(spark, which):
    docs = which(spark)
    want = sorted((repr(r[0]), skipchain.span_text(plain_base(r[1] or "") if len(r[1] or "") < 20_000 else skipchain.base_spans(r[1]))) for r in docs.select("doc_id", "text").collect())
    got = skipchain.find(docs).collect()
    assert sorted((repr(r["doc_id"]), r["base_spans"]) for r in got) == want
    for r in got:
        assert not r["base_spans"] or set(r["base_spans"].split(",")) <= set(r["spans"].split(","))
        assert r["n_added"] == len([s for s in r["spans"].split(",") if s]) - len([s for s in r["base_spans"].split(",") if s])


def test_mask(spark):
    docs = documents(spark).unionByName(odd_documents(spark), allowMissingColumns=True)
    field = skipchain.train(docs)
    clean = skipchain.mask(docs, field)
    assert clean.columns == docs.columns
    before = {(r["doc_id"], r["n_chars"]): r["text"] for r in docs.collect()}
    assert clean.count() == docs.count()
    for r in clean.collect():
        if r["text"] is not None:
            assert not plain_base(r["text"]) if len(r["text"]) < 20_000 else True
        else:
            assert (r["doc_id"], r["n_chars"]) in before
    untouched = skipchain.find(docs, field).where("spans = ''").select("doc_id").distinct()
    same = clean.join(untouched, "doc_id").select("doc_id", "text")
    assert same.exceptAll(docs.select("doc_id", "text")).count() == 0


def test_masked_text():
    assert skipchain.masked("a bb ccc", [(0, 2, 4), (1, 3, 6)]) == "a [EMAIL]cc"


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert skipchain.find(docs).count() == 0
    assert skipchain.mask(docs).count() == 0


@pytest.mark.parametrize("repeats", [1, 2, 10, 100])
def test_every_repeat_is_tied_to_the_label(repeats):
    """However often a number repeats outside, each repeat hears the labelled one as a single repeat does."""
    unary = np.zeros((skipchain._BUCKETS, 5))
    unary[:, 0] = 0.25
    field = skipchain.Field(unary, np.zeros((5, 5)), 5 * np.eye(5))
    g = skipchain.graph(["555-2485" + " or 555-2485" * repeats], [[(3, 0, 8)]])
    assert not len(g.chain)
    want = np.exp(5) / (np.exp(5) + np.exp(0.5) + 3)
    assert np.allclose(skipchain.beliefs(field, g)[1:, 4], want, atol=2e-3) and want > skipchain.SURE


@pytest.mark.parametrize("repeats", [2, 10, 100])
def test_all_repeats_are_found(spark, trained, repeats):
    text = "call +1 (968) 555-2485 now" + ", that is 555-2485 again" * repeats
    found = skipchain.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), trained).first()
    assert found["n_phone"] == 1 and found["n_added"] == repeats


def test_messages_pass_long_chains():
    """A label held at one end reaches the other as far as the chain allows; a document that settles early stays as it is."""
    field = skipchain.Field(np.zeros((skipchain._BUCKETS, 5)), 6 * np.eye(5), np.zeros((5, 5)))
    g = skipchain.graph([" ".join(f"{i}a" for i in range(100)), "1a 2a"], [[(0, 0, 2)], [(1, 0, 2)]])
    got = skipchain.beliefs(field, g)
    step = np.exp(6 * np.eye(5)) / np.exp(6 * np.eye(5)).sum(axis=1)
    assert np.allclose(got[99], np.linalg.matrix_power(step, 99)[1], atol=5e-3) and got[99, 1] > 0.4
    assert np.allclose(got[101], step[2], atol=2e-3)


def test_a_hub_is_exact():
    """Three like tokens without a label of the base: the exact marginals of a star."""
    rng = np.random.default_rng(6)
    tie = rng.normal(size=(5, 5))
    field = skipchain.Field(rng.normal(size=(skipchain._BUCKETS, 5)), rng.normal(size=(5, 5)), tie + tie.T)
    g = skipchain.graph(["12345 and 12345 and 12345"], [[]])
    assert not len(g.ties) and g.hubs.tolist() == [[0, 0], [0, 1], [0, 2]]
    local = field.unary[g.features[:, 0]] + field.unary[g.features[:, 1]]
    total = np.zeros((3, 5))
    for hub, *labels in itertools.product(range(5), repeat=4):
        weight = np.exp(sum(local[i, k] + field.tie[hub, k] for i, k in enumerate(labels)))
        for i, k in enumerate(labels):
            total[i, k] += weight
    assert np.allclose(skipchain.beliefs(field, g), total / total.sum(axis=1, keepdims=True), atol=2e-3)


@pytest.mark.parametrize(
    "base, other",
    [("+33 1 23 45 67 89", "0123456789"), ("+33 1 23 45 67 89", "01 23 45 67 89"), ("4111 1111 1111 1111", "4111.1111.1111.1111"), ("+33123456789", "01 23 45 67 89")],
)
def test_spans_of_short_tokens_are_tied(base, other):
    """Another form of a spaced number hears the label, token by token; a number beside it does not, nor does the span itself."""
    text = f"call {base} or in 2020 {other}, 1999 again"
    spans = skipchain.base_spans(text)
    g = skipchain.graph([text], [spans])
    label = spans[0][0] + 1
    heard = {text[slice(*g.spans[i])] for i, k in g.votes.tolist() if k == label}
    assert heard == {t for t in f"{other},".split()}


def test_a_spaced_number_takes_the_label_of_its_like(spark):
    rows = [(i, f"call +33 1 23 45 {i % 90 + 10} {i % 70 + 20} now, or 0123 at {i % 24}") for i in range(2000)]
    field = skipchain.train(spark.createDataFrame(rows, "doc_id long, text string"))
    text = "call +33 1 23 45 67 89 now, that is 01 23 45 67 89 again and 2020 not"
    found = skipchain.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), field).first()
    start = text.index("01 23")
    assert found["n_phone"] == 1 and f"phone:{start}:{start + 14}" in found["spans"].split(",") and found["n_added"] == 1
