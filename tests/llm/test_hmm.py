import math
import zlib
from collections import Counter

import numpy as np
import pytest

from panelweave.llm import hmm
from tests.llm.cases import documents, lower, odd_documents, rows_of, words


def small_chain(states=3, classes=5, seed=1):
    rng = np.random.default_rng(seed)
    part = lambda *shape: rng.dirichlet(np.ones(shape[-1]), shape[:-1] or None)
    return hmm.Chain(part(states), part(states, states), part(states, classes))


def paths(chain, seen):
    """All state paths with their probability."""
    out = {(): 1.0}
    for t, c in enumerate(seen):
        out = {
            (*p, s): w * (chain.move[p[-1], s] if p else chain.start[s]) * chain.emit[s, c] for p, w in out.items() for s in range(len(chain.start))
        }
    return out


SEQUENCES = [[0, 1, 2], [4], [3, 3, 1, 0, 2], [2, 2]]


def laid():
    cuts = np.append(0, np.cumsum([len(s) for s in SEQUENCES]))
    return np.concatenate(SEQUENCES), cuts


def test_forward_is_the_sum_over_all_paths():
    chain = small_chain()
    got = hmm.log_likelihoods(chain, *laid())
    want = [math.log10(sum(paths(chain, s).values())) for s in SEQUENCES]
    assert np.allclose(got, want)


def test_expected_counts():
    chain = small_chain()
    begin, moves, emissions, likelihood = hmm.expected_counts(chain, *laid())
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    total = 0.0
    for seen in SEQUENCES:
        all_paths = paths(chain, seen)
        whole = sum(all_paths.values())
        total += math.log10(whole)
        for path, weight in all_paths.items():
            want[0][path[0]] += weight / whole
            for a, b in zip(path, path[1:]):
                want[1][a, b] += weight / whole
            for s, c in zip(path, seen):
                want[2][s, c] += weight / whole
    for got, other in zip((begin, moves, emissions), want):
        assert np.allclose(got, other)
    assert np.isclose(likelihood, total)


def test_sequences_cover_all_tokens():
    cuts = hmm._sequences(np.array([0, 1, 300, 428, 428 + 129]))
    assert cuts[0] == 0 and cuts[-1] == 557 and np.diff(cuts).max() <= hmm.SEQUENCE and np.diff(cuts).min() >= 1
    assert {1, 300, 428} <= set(cuts.tolist())


def token_lists(docs):
    return [(r["doc_id"], [*words(lower(r["text"])), None]) for r in docs.select("doc_id", "text").collect()]


def out_of(key):
    return zlib.crc32(b"" if key is None else str(key).encode()) % 10 == 0


@pytest.mark.parametrize("which", [documents, odd_documents])
@pytest.mark.parametrize("frequent", [hmm.FREQUENT, 50])
def test_base(spark, monkeypatch, which, frequent):
    monkeypatch.setattr(hmm.train, "__defaults__", (6, 3, hmm.CLASSES, frequent))
    rows = token_lists(which(spark))
    count = Counter(w for i, tokens in rows if not out_of(i) for w in tokens)
    n, v = sum(count.values()), len(count)
    want = []
    for i, tokens in rows:
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        want.append((repr(i), out_of(i), len(tokens), sum(w in count for w in tokens), n, round(base, 5)))
    got = rows_of(hmm.score(which(spark)))
    columns = ("held_out", "n_tokens", "n_known", "train_tokens")
    assert sorted((repr(r["doc_id"]), *(r[c] for c in columns), round(r["base_score"], 5)) for r in got) == sorted(want)


def test_score_is_the_model_s(spark, monkeypatch):
    """The score from the model's parts, text by text, summed over all steps in plain recursion."""
    monkeypatch.setitem(hmm.train.__kwdefaults__, "own", 300)
    docs = documents(spark)
    renamed = docs.selectExpr("doc_id as id", "text")
    model, others = hmm.train(renamed)
    counts = dict(zip(model.words.tolist(), model.counts.tolist())) | {r["word"] % 2**64: r["count"] for r in others.collect()}
    got = {r["doc_id"]: r["score"] for r in rows_of(hmm.score(docs))}
    own = {h: k for k, h in enumerate(model.own.tolist())}
    assert 0 < len(own) < len(counts)
    from panelweave.llm import words as W
    import pyarrow as pa

    for row in docs.orderBy("doc_id").limit(15).collect():
        hashed, _ = hmm.tokens(next(W.blocks(pa.array([row["text"]]))))
        state, total = None, 0.0
        for t, h in enumerate(hashed.tolist()):
            c = hmm.CLASSES + own[h] if h in own else h % hmm.CLASSES
            state = (state @ model.chain.move if t else model.chain.start) * model.chain.emit[:, c]
            total += math.log10(state.sum())
            if h not in own:
                total += math.log10(counts.get(h, 0) + 0.1) - model.symbol_base[c]
            state = state / state.sum()
        assert math.isclose(total, got[row["doc_id"]], rel_tol=1e-9)


@pytest.mark.parametrize("own", [0, 300, hmm.OWN])
def test_the_model_is_a_distribution(spark, own):
    """Over a class, known words and one unknown word share all of its mass; a word of its own has all of its symbol's."""
    model, others = hmm.train(documents(spark).selectExpr("doc_id as id", "text"), own=own)
    counts = {**dict(zip(model.words.tolist(), model.counts.tolist())), **{r["word"] % 2**64: r["count"] for r in others.collect()}}
    assert len(counts) == model.vocabulary
    best = sorted(counts, key=lambda h: (-counts[h], h))[:own]
    assert set(model.own.tolist()) == {h for k, h in enumerate(best) if all(h % hmm.SLOTS != b % hmm.SLOTS for b in best[:k])}
    mass = np.append(np.full(hmm.CLASSES, 0.1), np.zeros(len(model.own)))
    for h, s in zip(counts, model.symbols(np.array(list(counts), np.uint64)).tolist()):
        mass[s] += counts[h] + 0.1
    assert np.allclose(np.log10(mass), model.symbol_base)
    assert np.allclose(model.chain.emit.sum(axis=1), 1) and np.allclose(model.chain.move.sum(axis=1), 1)


def test_training_raises_the_likelihood_and_beats_counts_on_held_out_texts(spark):
    docs = documents(spark, "/root/testdata/sf0.01").selectExpr("doc_id as id", "text")
    classes = np.zeros(hmm.CLASSES)
    for r in hmm.count_words(docs).collect():
        classes[r["word"] % hmm.CLASSES] += r["count"]
    _, likelihoods = hmm.baum_welch(docs, classes, 6, 4)
    assert likelihoods == sorted(likelihoods)
    held = hmm.score(docs, key="id").where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]


def test_symbols():
    own = np.sort(np.array([5, 5 + hmm.CLASSES, 2**63 + 77], np.uint64))
    seen = np.array([5, 6, 5 + hmm.CLASSES, 5 + hmm.SLOTS, 2**63 + 77, 2**63 + 77 + hmm.SLOTS, 0], np.uint64)
    want = [hmm.CLASSES + own.tolist().index(h) if h in own.tolist() else h % hmm.CLASSES for h in seen.tolist()]
    assert hmm.symbols(seen, own, hmm.CLASSES).tolist() == want


def test_own_emissions_beat_classes_on_held_out_texts(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    scores = {}
    for own in (0, hmm.OWN):
        model, _ = hmm.train(docs.selectExpr("doc_id as id", "text"), own=own)
        tokens = [(hmm.tokens(block), r) for r, block in held_blocks(docs)]
        scores[own] = sum(
            float(hmm.log_likelihoods(model.chain, model.symbols(h), cuts).sum() - model.symbol_base[model.symbols(h)].sum() + logs(model, h)) for (h, cuts), _ in tokens
        )
    assert scores[hmm.OWN] > scores[0]


def held_blocks(docs):
    import pyarrow as pa

    from panelweave.llm import words as W

    for r in docs.orderBy("doc_id").collect():
        if out_of(r["doc_id"]):
            yield r, next(W.blocks(pa.array([r["text"]])))


def logs(model, hashed):
    """log10 of the smoothed counts; the head of this table holds all words."""
    counts = dict(zip(model.words.tolist(), model.counts.tolist()))
    return sum(math.log10(counts.get(h, 0) + 0.1) for h in hashed.tolist())


def test_training_stops_once_a_round_gains_little(spark):
    docs = documents(spark).selectExpr("doc_id as id", "text")
    every, _ = hmm.train(docs, rounds=5, tolerance=0.0)
    gains = np.diff(every.likelihoods) / every.train_tokens
    assert len(every.likelihoods) == 5 and (gains > 0).all()
    few, _ = hmm.train(docs, rounds=5, tolerance=float(gains[1]) + 1e-9)
    assert len(few.likelihoods) == (2 if gains[0] < gains[1] else 3)


def test_empty_table(spark):
    assert hmm.score(documents(spark).limit(0)).count() == 0


def test_nothing_to_train_on(spark):
    docs = documents(spark).where("crc32(cast(cast(doc_id as string) as binary)) % 10 = 0")
    got = hmm.score(docs)
    assert got.count() == docs.count() and got.where("n_known > 0 or train_tokens > 0 or score is null").count() == 0
