import hashlib
from collections import defaultdict

import pytest

from panelweave.llm import queries, raking
from tests.llm.cases import documents, odd_documents, rows_of, words


def plain(rows, powers, sweeps):
    """Raking by loops; rows of id, text and categories."""
    cells = defaultdict(float)
    named = []
    for i, text, source, lang in rows:
        n = len(words(text))
        cell = (source, lang, "short" if n < 100 else "medium" if n < 1000 else "long")
        cells[cell] += n
        named.append((i, cell))
    weight = dict(cells)
    for _ in range(sweeps):
        for m, power in enumerate(powers):
            sums, now = defaultdict(float), defaultdict(float)
            for cell in cells:
                sums[cell[m]] += cells[cell]
                now[cell[m]] += weight[cell]
            total = sum(s**power for s in sums.values() if s)
            for cell in weight:
                name = cell[m]
                weight[cell] *= (sums[name] ** power / total / now[name]) if now[name] else 0
    top = max((weight[c] / cells[c] for c in cells if cells[c]), default=1)
    share = {c: round(weight[c] / cells[c] / top, 9) if cells[c] else 1.0 for c in cells}
    out = []
    for i, cell in named:
        digest = hashlib.md5((str(i) if i is not None else "").encode()).hexdigest()
        out.append((repr(i), *map(str, cell), round(share[cell], 6), int(digest[:13], 16) / 16**13 < share[cell]))
    return sorted(out)


@pytest.mark.parametrize("which", [documents, odd_documents])
def test_raked(spark, which):
    powers = {"source": 0.5, "lang": 0.9, "topic": 0.8}
    docs = which(spark).withColumn("weight", raking.F.lit("clash"))
    got = rows_of(raking.mixed(docs, powers, 5))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()]
    columns = ("source", "lang", "topic")
    assert sorted((repr(r["doc_id"]), *(str(r[c]) for c in columns), round(r["probability"], 6), r["kept"]) for r in got) == plain(rows, powers.values(), 5)


def test_margins_meet_their_targets(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    target = spark.createDataFrame([("en", 0.4), ("de", 0.2), ("fr", 0.3), ("es", 0.1), ("nowhere", 0.5)], "name string, target double")
    mixed = raking.mixed(docs, {"source": 0.5, "lang": target}, 20)
    expected = {r["lang"]: r["n"] for r in mixed.groupBy("lang").agg(raking.F.sum(raking.F.col("n_tokens") * raking.F.col("probability")).alias("n")).collect()}
    total = sum(expected.values())
    for lang, share in (("en", 0.4), ("de", 0.2), ("fr", 0.3), ("es", 0.1)):
        assert abs(expected[lang] / total - share) < 1e-4
    assert mixed.agg(raking.F.max("probability")).first()[0] == 1


def test_null_categories_and_no_target(spark):
    rows = [(1, "a b c", None, "en"), (2, "a b", "s", None), (3, "a", "t", "en"), (4, None, "t", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    target = spark.createDataFrame([(None, 0.5), ("s", 0.5)], "name string, target double")
    got = {r["doc_id"]: r for r in rows_of(raking.mixed(docs, {"source": target}, 3))}
    assert got[3]["probability"] == 0 and not got[3]["kept"]
    assert got[1]["probability"] > 0 and got[2]["probability"] > 0


def test_draw(spark):
    docs = documents(spark).unionByName(odd_documents(spark), allowMissingColumns=True)
    powers = {"source": 0.5, "lang": 0.9, "topic": 0.8}
    drawn = raking.draw(docs, powers, 4)
    assert drawn.columns == docs.columns
    mixed = raking.mixed(docs, powers, 4).where("kept")
    assert sorted(repr(r[0]) for r in drawn.select("doc_id").collect()) == sorted(repr(r[0]) for r in mixed.select("doc_id").collect())


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert raking.mixed(docs, {"source": 0.5}, 2).count() == 0
    assert raking.draw(docs, {"source": 0.5}, 2).count() == 0


def test_a_rare_source_does_not_sink_the_sample(spark):
    """One document of a source of its own, in a table where the others are even."""
    rows = [(i, "w " * 200, f"s{i % 4}", "en") for i in range(4000)] + [(4000, "w " * 200, "rare", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    tokens = raking.F.sum(raking.F.col("n_tokens") * raking.F.col("probability")) / raking.F.sum("n_tokens")
    assert raking.mixed(docs, queries.MIX, 2).agg(tokens).first()[0] < 0.2
    mixed = raking.mixed(docs, queries.MIX, 2, keep=queries.KEEP)
    assert abs(mixed.agg(tokens).first()[0] - queries.KEEP) < 1e-6
    shares = {r["source"]: r["probability"] for r in mixed.select("source", "probability").distinct().collect()}
    assert shares.pop("rare") == 1 and len(shares) == 4 and max(shares.values()) - min(shares.values()) < 1e-6


@pytest.mark.parametrize("keep", [0.05, 0.3, 0.6, 0.9, 1.0])
def test_capped_cells_pass_their_weight_on(spark, keep):
    """Against the scale found by bisection; the cell without weight is never kept."""
    cells = [(1.0, 0.2), (10.0, 0.3), (100.0, 0.3), (1000.0, 0.2), (50.0, 0.0), (0.0, 0.0)]
    fitted = spark.createDataFrame(cells, "tokens double, weight double")
    got = {r["tokens"]: r["probability"] for r in rows_of(raking.probabilities(fitted, keep))}
    assert got[50.0] == 0 and got[0.0] == 1
    kept = lambda scale: sum(min(t, w * scale) for t, w in cells)
    low, high = 5.0, 1e9
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (low, middle) if kept(middle) >= keep * 1161 else (middle, high)
    for t, w in cells[:4]:
        assert abs(got[t] - min(1, w * high / t)) < 1e-6


def test_sweeps_go_on_until_the_margins_fit(spark):
    """Sources that mostly hold one language: six sweeps leave the margins off."""
    rows = [(f"s{s}", f"l{g}", 990.0 * (1 + s) if s == g else 10.0 * (1 + g)) for s in range(3) for g in range(3)]
    cells = spark.createDataFrame(rows, "source string, lang string, tokens double")
    targets = {m: raking.tempered(cells, m, p) for m, p in (("source", 0.3), ("lang", 0.9))}
    assert raking.margin_error(raking.rake(cells, targets, queries.SWEEPS), targets) > 0.05
    assert raking.margin_error(raking.rake(cells, targets, queries.SWEEPS, 0.01), targets) <= 0.01


def test_margins_that_cannot_fit_end_with_a_warning(spark):
    cells = spark.createDataFrame([("s", "x", 1.0), ("t", "y", 1.0)], "source string, lang string, tokens double")
    half = spark.createDataFrame([("s", 0.5), ("t", 0.5)], "name string, target double")
    uneven = spark.createDataFrame([("x", 0.9), ("y", 0.1)], "name string, target double")
    with pytest.warns(UserWarning, match="off their targets by up to 0.8"):
        raking.rake(cells, {"source": half, "lang": uneven}, 2, 1e-4)


def test_query_meets_its_margins(spark):
    """Tokens kept by op10 in expectation, by margin, against targets worked out anew."""
    rows = rows_of(queries.op10_raking(spark, "/root/testdata/sf0.01"))
    kept = sum(r["n_tokens"] * r["probability"] for r in rows)
    for margin, power in queries.MIX.items():
        counted, drawn = defaultdict(float), defaultdict(float)
        for r in rows:
            counted[r[margin]] += r["n_tokens"]
            drawn[r[margin]] += r["n_tokens"] * r["probability"]
        total = sum(n**power for n in counted.values())
        for name, n in counted.items():
            assert abs(drawn[name] / kept / (n**power / total) - 1) <= 2 * queries.TOLERANCE
