import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelweave.llm import ranks
from tests.llm.cases import documents, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = ranks.read_vocabulary(PATH)
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = ranks.Encoder(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"], max_codepoint=0x2FFF)) | st.text("ab '<|endofxt>\n\t é1²"))
def test_any_text_as_the_library(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    got = ENCODER.encode(text)
    assert got.tolist() == want
    assert ENCODER.decode(got) == LIBRARY.decode(want, skip_special_tokens=False) == text


@settings(max_examples=100, deadline=None)
@given(st.binary(min_size=1, max_size=400))
def test_long_words_as_short_ones(word):
    assert ranks.merge_long(word, VOCABULARY) == ranks.merge_short(word, VOCABULARY)


def test_word_of_one_letter():
    text = "a" * 30_000
    assert ENCODER.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_listed_piecewise(monkeypatch):
    text = "it's <|endoftext|> 12  é \n" * 50
    whole = ENCODER.encode(text).tolist()
    monkeypatch.setattr(ranks, "_LISTED", 10)
    assert ranks.Encoder(VOCABULARY).encode(text).tolist() == whole


@pytest.mark.parametrize("which", [documents, odd_documents])
def test_digests(spark, which):
    docs = which(spark)
    want = []
    for row in docs.select("doc_id", "text").collect():
        ids = LIBRARY.encode(row["text"] or "", add_special_tokens=False).ids
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want.append((row["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = [tuple(r) for r in ranks.digests(docs, VOCABULARY).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_round_trip_and_empty_table(spark):
    docs = odd_documents(spark)
    decoded = ranks.encode(docs, VOCABULARY).select("decoded").collect()
    assert sorted(r[0] for r in decoded) == sorted(r[0] or "" for r in docs.select("text").collect())
    assert ranks.encode(docs.limit(0), VOCABULARY).count() == 0
