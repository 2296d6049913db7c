"""Byte-level BPE against the library that merges by ranks, and exact round trips."""
import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from llm_helpers import documents
from railpulse.llm import byte_bpe
from railpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def by_ranks(name=byte_bpe.RANKS):
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def v():
    return byte_bpe.load()


def encode(v, texts):
    ids, counts = v.encoder.encode(texts)
    return [own.tolist() for own in np.split(ids, np.cumsum(counts)[:-1])]


ALPHABET = "aAbc'stlé中 \n\t1 9.,!\U0001F600́\x00\x85 　"


@pytest.mark.parametrize("name", [byte_bpe.RANKS, "byte_bpe_multi_50k.tiktoken"])
def test_ids_are_those_of_a_merge_by_ranks(name):
    v, reference, rng = byte_bpe.load(public_tokenizers.path(name)), by_ranks(name), random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randrange(80))) for _ in range(3000)]
    texts += ["a" * n for n in range(1, 60)] + ["", "<|endoftext|>", "x" * 20_000, "  \n  "]
    assert encode(v, texts) == [reference.encode_ordinary(t) for t in texts]


@given(st.lists(st.text(max_size=60), max_size=5))
@settings(max_examples=200, deadline=None)
def test_any_text(texts):
    v = VOCABULARY
    ids = encode(v, texts) if texts else []
    assert ids == [REFERENCE.encode_ordinary(t) for t in texts]
    for t, own in zip(texts, ids):
        assert byte_bpe.decode(np.array(own, dtype=np.int64), v)[0].tobytes().decode() == t


VOCABULARY, REFERENCE = byte_bpe.load(), by_ranks()


@given(st.text(alphabet=ALPHABET, max_size=200), st.integers(1, 12))
@settings(max_examples=300, deadline=None)
def test_parts_are_cut_where_every_match_ends(text, limit):
    cut = list(byte_bpe.parts(text, limit))
    assert "".join(cut) == text
    assert [i for p in cut for i in REFERENCE.encode_ordinary(p)] == REFERENCE.encode_ordinary(text)


@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_offsets(texts):
    v = VOCABULARY
    ids, counts = v.encoder.encode(texts)
    starts, ends = byte_bpe.spans(ids, counts, v)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        place = [i for i, c in enumerate(text) for _ in c.encode()]  # character of every byte
        byte = 0
        for i in range(at, at + n):
            size = len(v.tokens[ids[i]])
            assert (starts[i], ends[i]) == (place[byte], place[byte + size - 1] + 1)
            byte += size
        at += n


def test_split_characters(v):
    text = "a\U0001F600é中 end"
    ids = encode(v, [text])[0]
    pieces = byte_bpe.texts_of_tokens(ids, v)
    assert "".join(pieces) == text and "" in pieces
    assert byte_bpe.texts_of_tokens(ids[:2], v)[-1] == "�"  # the rest of the character is missing
    assert byte_bpe.texts_of_tokens([-1, v.size], v) == ["", ""]


def test_remembering_does_not_change_ids(v):
    forgetful = byte_bpe.Encoder(v, memory=3)
    for text in ["some words here", "other words there", "some words here"]:
        assert forgetful.encode([text])[0].tolist() == REFERENCE.encode_ordinary(text)


def test_documents(spark, tricky, nothing):
    encoded = byte_bpe.encode_documents(tricky, offsets=True, carry=("doc_id", "text"))
    rows = byte_bpe.decode_documents(encoded).collect()
    assert len(rows) == tricky.count()
    for r in rows:
        text = r["text"] or ""
        assert r["tokens"] == REFERENCE.encode_ordinary(text) and bytes(r["decoded"]).decode() == text
        assert len(r["starts"]) == len(r["ends"]) == len(r["tokens"])
        assert not r["ends"] or (r["starts"][0], r["ends"][-1]) == (0, len(text))
    assert byte_bpe.decode_documents(byte_bpe.encode_documents(nothing)).count() == 0
    ids = spark.createDataFrame([(1, None), (2, []), (3, [None, 64, 99_999_999])], "doc_id long, tokens array<int>")
    assert [bytes(r["decoded"]) for r in byte_bpe.decode_documents(ids).orderBy("doc_id").collect()] == [b"", b"", b"a"]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op12_byte_bpe"](spark, SF)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = REFERENCE.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    empty = documents(spark, [(1, None), (2, "")])
    assert {r["n_tokens"] for r in byte_bpe.encode_documents(empty).select(F.size("tokens").alias("n_tokens")).collect()} == {0}
