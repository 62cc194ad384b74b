import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from trafficlens.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def known():
    tokens = bpe.read_ranks(PATH)
    return bpe.PreTokens(tokens, *bpe.perfect_hash(tokens))


FIND = regex.compile(public_tokenizers.PATTERN).findall


def test_perfect_hash_is_minimal_and_exact(known):
    assert sorted(known.owners) == list(range(len(known.tokens)))
    assert all(known.whole(token) == rank for rank, token in enumerate(known.tokens))
    assert known.whole(b"no such entry in the vocabulary") == -1


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_encoding_matches_tiktoken(reference, known, text):
    ids = np.frombuffer(bpe.encode_text(text, FIND, known), "<u4").tolist()
    assert ids == reference.encode_ordinary(text)


def test_long_pretokens(reference, known):
    for text in ("a" * 5000, "xyz" * 2000, " " * 3000, "<|endoftext|>", "日本語" * 400, "\x00\x01" * 50):
        assert np.frombuffer(bpe.encode_text(text, FIND, known), "<u4").tolist() == reference.encode_ordinary(text)


def test_memory_is_bounded(monkeypatch, known):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.PreTokens(known.tokens, known.displacements, known.owners)
    for k in range(20):
        bpe.encode_text(f"word{k} other{k}", FIND, small)
        assert len(small) < 12


def test_query_round_trip(spark, reference):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = bpe.op2_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark, odd_docs):
    encoded = bpe.encode_documents(odd_docs, PATH, public_tokenizers.PATTERN, keep=("text", "words"))
    rows = bpe.decode_documents(encoded, PATH).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
    assert bpe.encode_documents(odd_docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_long_pre_tokens_are_not_remembered():
    """Distinct pre-tokens of 10 kB each leave the worker's memory as it was, and are encoded as ever."""
    import public_tokenizers
    from trafficlens.llm import bpe

    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = bpe.PreTokens(tokens, *bpe.perfect_hash(tokens))
    for k in range(30):
        word = f"x{k}" * 3000
        packed = known[word]
        assert len(packed) % 4 == 0 and packed == known[word]
    known["short"]
    assert list(known) == ["short"]


def test_decoding_in_the_same_pass_equals_decoding_stored_ids(spark, odd_docs):
    import public_tokenizers
    from trafficlens.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    both = bpe.encode_documents(odd_docs, path, public_tokenizers.PATTERN, keep=("lang", "row"), decode=True)
    alone = bpe.decode_documents(bpe.encode_documents(odd_docs, path, public_tokenizers.PATTERN, keep=("lang", "row")), path)
    assert both.columns == alone.columns == ["doc_id", "lang", "row", "ids", "decoded"]
    assert sorted(map(str, both.collect())) == sorted(map(str, alone.collect()))
    texts = sorted((r["text"] or "").encode() for r in odd_docs.collect())
    assert sorted(bytes(r["decoded"]) for r in both.collect()) == texts
