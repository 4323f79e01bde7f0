import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelweave.llm import prefixjoin, queries, repetition, skipchain
from registry.queries import QUERIES
from tests.compare import connect, difference
from tests.llm import test_prefixjoin, test_raking, test_repetition
from tests.llm.cases import documents, odd_documents

SF_DIR = "/root/testdata/sf0.01"


def texts(df):
    return sorted((repr(r["doc_id"]), repr(r["text"])) for r in df.select("doc_id", "text").collect())


def test_stages_against_plain_versions(spark):
    """Each stage on what the one before kept, with all columns."""
    sf_dir = "/root/testdata/sf0.001"
    odd = odd_documents(spark).withColumn("doc_id", F.col("doc_id") + 10_000)
    docs = documents(spark, sf_dir).unionByName(odd, allowMissingColumns=True)
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = stages["quality"](spark, docs, sf_dir).cache()
    assert kept.columns == columns
    assert texts(kept) == sorted((repr(r["doc_id"]), repr(r["text"])) for r in docs.collect() if test_repetition.plain(r["text"])["kept"])

    once = stages["near_duplicates"](spark, kept, sf_dir).cache()
    assert once.columns == columns
    groups = {i: c for i, _, c in test_prefixjoin.plain([tuple(r) for r in kept.select("doc_id", "text").collect()])}
    assert {repr(r["doc_id"]) for r in once.collect()} == {i for i, c in groups.items() if c is None or i == repr(c)}

    clean = stages["personal_data"](spark, once, sf_dir).cache()
    assert clean.columns == columns and clean.count() == once.count()
    assert skipchain.find(clean).where("base_spans != ''").count() == 0

    mixed = stages["mixing"](spark, clean, sf_dir).cache()
    assert mixed.columns == columns
    rows = [tuple(r) for r in clean.select("doc_id", "text", "source", "lang").collect()]
    want = [r[0] for r in test_raking.plain(rows, queries.MIX.values(), queries.SWEEPS) if r[-1]]
    assert sorted(repr(r["doc_id"]) for r in mixed.collect()) == sorted(want)

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = {r["doc_id"]: r for r in stages["encoding"](spark, mixed, sf_dir).collect()}
    for r in mixed.collect():
        assert encoded[r["doc_id"]]["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert encoded[r["doc_id"]]["decoded"] == (r["text"] or "")


def test_run(spark):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert got.count() > 100
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "encoding"]


def test_clean_documents_stay(spark):
    docs = documents(spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1").select("doc_id")
    long = repetition.measure(docs).where("n_words >= 50").select("doc_id")
    clean = docs.join(labels, "doc_id").join(long, "doc_id").select(*docs.columns)
    kept = corpus_pipeline.quality(spark, clean, SF_DIR)
    assert kept.count() >= 0.97 * clean.count()
    first = prefixjoin.near_duplicates(clean).select("component_id").distinct().count()
    assert corpus_pipeline.near_duplicates(spark, clean, SF_DIR).count() == first


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    if name in queries.ORACLE:
        assert difference(df, connect(SF_DIR), queries.ORACLE[name]) is None
    else:
        rows, key = ("pages", "page_id") if name.startswith("op8") else ("documents", "doc_id")
        # A long document is several pieces where sequences are packed.
        assert df.select(key).distinct().count() == spark.read.parquet(f"{SF_DIR}/{rows}.parquet").count()


def test_run_on_an_empty_table(spark, tmp_path):
    documents(spark).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_points():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert set(queries.QUERIES) | set(QUERIES) | {"pipeline"} == names
    assert set(__spark_entry__.oracle_sql()) <= names
