"""Byte-level BPE (prefix tables) and the Simple-8b token store."""

from __future__ import annotations

import hashlib
import itertools
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerflow.llm import byte_bpe, pieces, pretoken, queries, token_store

with open(queries.RANKS, "rb") as _f:
    VOCABULARY = byte_bpe.vocabulary(_f.read())
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
PATTERN = regex.compile(public_tokenizers.PATTERN)
TRICKY = st.text(alphabet=list(" \n\t'stmdrevl12é!?-ßa中　\xa0①B_😀"), max_size=40)
TEXTS = ["", None, "plain words, it's we'll 'tis", "  \n\n  tail  ", "a" * 700, "é中文😀 mixed\tTabs", "x y" * 3000, "plain words, it's we'll 'tis", " ", " 'S 's's"]


@settings(max_examples=300, deadline=None)
@given(st.lists(TRICKY, min_size=1, max_size=4))
def test_split_is_the_patterns(texts):
    joined, want, at = "".join(texts), [], 0
    breaks = np.cumsum([0] + [len(t) for t in texts])[:-1]
    for t in texts:
        want += [at + m.start() for m in PATTERN.finditer(t)]
        at += len(t)
    assert pretoken.split(joined, breaks).tolist() == (want + [len(joined)] if joined else [0])


@settings(max_examples=200, deadline=None)
@given(TRICKY, st.integers(0, 40), st.integers(0, 10), TRICKY, TRICKY)
def test_edits_and_appends_are_exact(text, start, length, by, more):
    held = byte_bpe.EncodedText(VOCABULARY, text)
    assert held.ids() == TIKTOKEN.encode_ordinary(text)
    start = min(start, len(text))
    stop = min(start + length, len(text))
    held.replace(start, stop, by)
    edited = text[:start] + by + text[stop:]
    assert held.text == edited and held.ids() == TIKTOKEN.encode_ordinary(edited)
    held.append(more)
    assert held.ids() == TIKTOKEN.encode_ordinary(edited + more)


def test_an_edit_touches_entries_near_it_only():
    table = byte_bpe.PrefixTable(VOCABULARY)
    raw = b" the quick brown fox jumps over the lazy dog" * 60
    table.append(raw)
    touched = table.replace(500, 503, b"XYZ")
    again = byte_bpe.PrefixTable(VOCABULARY)
    again.append(raw[:500] + b"XYZ" + raw[503:])
    assert table.last == again.last and touched < 400


def test_encode_and_decode_whole_texts(docs_of):
    rows = byte_bpe.encode(docs_of(TEXTS), queries.RANKS).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = TEXTS[r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == TIKTOKEN.encode_ordinary(text)
        assert bytes(r["decoded"]).decode() == text
    packed = byte_bpe.encode(docs_of(TEXTS), queries.RANKS).select("doc_id", "ids")
    assert {bytes(r["decoded"]).decode() for r in byte_bpe.decode(packed, queries.RANKS).collect()} == {t or "" for t in TEXTS}


def test_op2_digests(spark, docs_of, save):
    path = save(documents=docs_of(TEXTS).withColumn("ids", F.lit("clash")))
    for r in queries.op2_prefix_dp_bpe(spark, path).collect():
        ids = TIKTOKEN.encode_ordinary(TEXTS[r["doc_id"]] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((TEXTS[r["doc_id"]] or "").encode()).hexdigest()
    assert queries.op2_prefix_dp_bpe(spark, save(documents=docs_of(TEXTS).limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, (1 << 64) - 1)), max_size=3000))
def test_pack_round_trip(values):
    assert token_store.unpack(token_store.pack(np.array(values, np.uint64))).tolist() == values


@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_pack_groups_and_density(n):
    small = np.ones(n, np.uint64)
    payload = token_store.pack(small)
    assert token_store.unpack(payload).tolist() == small.tolist()
    assert len(payload) <= 12 + 4 * (n // 1024 + 2) + 8 * (n // 60 + n // 1024 + 2)


def test_op3_reads_its_files_back(spark, docs_of, save, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 2000)  # several blocks a part
    ids = [7, 3, 50, 4, 900, 12, 1, 8, 60, 2]
    path = save(documents=docs_of(TEXTS, ids=ids))
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    got, start = {r["doc_id"]: r for r in queries.op3_simple8b_token_store(spark, path).collect()}, 0
    assert len(got) == len(ids)
    for doc_id, text in sorted(zip(ids, TEXTS)):
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own)))
        start += len(own)
    assert queries.op3_simple8b_token_store(spark, save(documents=docs_of(TEXTS).limit(0))).count() == 0


def test_store_keeps_repeated_ids(spark, docs_of, tmp_path):
    blocks = token_store.write_store(docs_of(["a b", "c", "a b"], ids=[1, 1, 1]), f"{tmp_path}/store", queries.TOKENIZER)
    assert token_store.read_documents(blocks).count() == 3


def thue_morse(one, two, n):
    """Words that every polynomial hash modulo a power of two confuses."""
    return "".join(two if bin(k).count("1") % 2 else one for k in range(n))


HARD = [thue_morse(*pair, n) for n in (512, 1024, 2048) for pair in ("ab", "ba", "ad", "da")]
HARD += ["a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "don't<|endoftext|>'s 12<|endoftext|>3  ", "<|endo", "ftext|>", "end <|endoftext|>", "<|endoftext|", "|>"]


def test_words_that_collide_under_a_hash_and_added_tokens(spark, docs_of, save):
    path = save(documents=docs_of(HARD))
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    want3 = {k: zlib.crc32(np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for k, t in enumerate(HARD)}
    assert {r["doc_id"]: r["ids_crc32"] for r in queries.op3_simple8b_token_store(spark, path).collect()} == want3
    want2 = {k: hashlib.sha256(np.array(TIKTOKEN.encode_ordinary(t), "<u4").tobytes()).hexdigest() for k, t in enumerate(HARD)}
    got2 = queries.op2_prefix_dp_bpe(spark, path).collect()
    assert {r["doc_id"]: r["ids_sha256"] for r in got2} == want2
    assert {r["doc_id"]: r["decoded_sha256"] for r in got2} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in enumerate(HARD)}


def test_piece_memory_is_bounded_and_changes_no_result():
    words = ["".join(x) for x in itertools.product("abcdef", repeat=4)]
    column = pa.array([" ".join(words[k:k + 50]).encode() for k in range(0, 1200, 50)], pa.binary())
    large, small = (pieces.PieceEncoder(VOCABULARY.encode_all, cache=c) for c in (1 << 30, 1 << 10))
    for part in (column, column.slice(3, 5), column):
        assert all((a == b).all() for a, b in zip(large.ids(part), small.ids(part)))
        small.ids(pa.array([b"x"], pa.binary()))
        assert len(small.index) < 10 < len(large.index)
