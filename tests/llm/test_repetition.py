from collections import Counter

from panelweave.llm import repetition
from tests.llm.cases import documents, odd_documents, rows_of, words


def plain(text):
    rules = repetition.Rules()
    found = words(text)
    total = max(sum(map(len, found)), 1)
    out = {"n_words": len(found), "word_chars": sum(map(len, found)), "n_symbols": sum(c in "#*$%&|<>" for c in text or "")}
    lines = [line for line in (text or "").split("\n") if words(line)]
    again = [line for i, line in enumerate(lines) if line in set(lines[:i])]
    out["n_dup_lines"] = len(again)
    line_share = len(again) / max(len(lines), 1)
    char_share = sum(map(len, again)) / max(len(text or ""), 1)
    long = len(found) >= rules.long_words
    passes = line_share <= (rules.long_lines if long else rules.lines) and char_share <= (rules.long_line_chars if long else rules.line_chars)
    passes = passes and out["n_symbols"] <= rules.symbols * len(found)

    def grams(n):
        return [tuple(found[i : i + n]) for i in range(len(found) - n + 1)]

    triples = grams(3)
    count = Counter(triples)
    out["n_repeat_words"] = len({i + k for i, g in enumerate(triples) if count[g] > 1 for k in range(3)})
    for n, limit in rules.long_top if long else rules.top:
        count = Counter(grams(n))
        passes &= max((c * sum(map(len, g)) for g, c in count.items() if c > 1), default=0) / total <= limit
    for n, limit in rules.long_repeated if long else rules.repeated:
        seen, inside = set(), set()
        for i, g in enumerate(grams(n)):
            if g in seen:
                inside |= set(range(i, i + n))
            seen.add(g)
        share = sum(len(found[i]) for i in inside) / total
        out[f"repeated_{n}_share"] = share
        passes &= share <= limit
    out["base_failed"] = len(found) < 50 or 100 * out["n_repeat_words"] > 50 * len(found)
    out["kept"] = passes and not out["base_failed"]
    return out


def agree(docs):
    texts = Counter((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    want = Counter()
    for (i, t), n in texts.items():
        want[(i, tuple((k, round(v, 9)) for k, v in sorted(plain(t).items())))] += n
    names = sorted(plain("a"))
    got = Counter((r["doc_id"], tuple((k, round(r[k], 9)) for k in names)) for r in rows_of(repetition.measure(docs)))
    assert got == want


def test_odd_rows(spark):
    agree(odd_documents(spark))


def test_documents(spark):
    agree(documents(spark))


def test_limits_are_looser_for_short_texts_only(spark):
    """A sixth of the words in repeated runs: a long page goes, a short one stays."""
    long = " ".join([*(f"a{i}" for i in range(400)), *(f"b{i}" for i in range(4000)), *(f"a{i}" for i in range(400)), *(f"a{i}" for i in range(400))])
    short = " ".join([*(f"a{i}" for i in range(20)), *(f"b{i}" for i in range(100)), *(f"a{i}" for i in range(20))])
    docs = spark.createDataFrame([(4, long), (5, short), (3, " ".join(f"w{i}" for i in range(5000)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows_of(repetition.measure(docs))}
    assert 0.1 < got[4]["repeated_10_share"] < 0.25 and 0.1 < got[5]["repeated_10_share"] < 0.25
    assert [got[i]["kept"] for i in (3, 4, 5)] == [True, False, True]
    agree(docs)


def test_keep_returns_whole_rows(spark):
    docs = documents(spark).unionByName(odd_documents(spark), allowMissingColumns=True)
    measured = repetition.measure(docs).where("kept").select("doc_id")
    kept = repetition.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in measured.collect())


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert repetition.measure(docs).count() == 0
    assert repetition.keep(docs).count() == 0


def test_labels(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    long = repetition.measure(docs).where("n_words >= 50").join(labels, "doc_id")
    clean = long.where("quality = 1")
    assert clean.where("kept").count() >= 0.995 * clean.count()
    bad = long.where("quality = 0")
    assert bad.where("kept").count() <= 0.2 * bad.count()
