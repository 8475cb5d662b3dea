"""Token counts, packing and personal data against the libraries and plain patterns."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import packing, personal_data, token_counts
from ebbtide.llm.pretokens import ByteCounts, WordIds
from ebbtide.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a  b", "a \n b  ", "it's <|endoftext|> ok", "a<|endoftext|>b", "x　y", "é ÀB İI ΣΑΣ",
    "tab\t x", "\x1c a\x1cb", "don't'll 12 345", "日本 123", "²½ x² ª", "ß ẞ", "AB12cd!!34", "​ ﻿ x", "  a",
]
texts = st.text(st.sampled_from("ab A1'.,<|>\n\t  éß́日\x1c"), max_size=40)


@pytest.fixture(scope="module")
def odd_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "no id", None), (7, None, "x"), (7, None, "x"), (8, "long word " * 9000, "x"), (9, "z" * 40000, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, `a.b` string").withColumn("n_tokens", F.lit("clash"))


@given(texts)
@settings(max_examples=400, deadline=None)
def test_counts_and_ids_are_the_librarys(text):
    counts, words = _kept(ByteCounts, BYTES), _kept(WordIds, WORDS)
    assert counts.count(text) == counts.direct(text)
    assert words.ids(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


_MADE = {}


def _kept(kind, path):
    return _MADE.setdefault(kind, kind(path)) if kind in _MADE else _MADE.setdefault(kind, kind(path))


@given(texts, st.integers(1, 30), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_chunks_resynchronise(text, chunk, overlap):
    tokenizer = _kept(ByteCounts, BYTES).tokenizer
    whole = len(tokenizer.encode(text, add_special_tokens=False))
    assert token_counts.count_by_chunks(tokenizer, text, chunk, overlap)[0] == whole


def test_overlaps_widen_where_nothing_is_proven():
    tokenizer = Tokenizer.from_file(BYTES)
    text = "x" * 3000 + " end"
    assert token_counts.count_by_chunks(tokenizer, text, 300, 8)[0] == len(tokenizer.encode(text, add_special_tokens=False))
    assert token_counts.count_by_chunks(tokenizer, text, 300, 8)[1] > 0


def test_token_counts(spark, odd_rows):
    tokenizer = Tokenizer.from_file(BYTES)
    for row, got in zip(odd_rows.collect(), token_counts.count_tokens(odd_rows, BYTES).collect()):
        text = row["text"] or ""
        n = len(tokenizer.encode(text, add_special_tokens=False))
        assert tuple(got)[:4] == (row["doc_id"], len(text.encode()), n, n > 1024)
    assert token_counts.count_tokens(odd_rows.limit(0), BYTES).count() == 0


def test_fill_is_the_best_subset_sum():
    rng = np.random.default_rng(3)
    for _ in range(60):
        counts = {int(n): int(rng.integers(1, 4)) for n in rng.integers(1, 40, 5)}
        room = int(rng.integers(1, 90))
        used = packing.fill(counts, room)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)
        assert all(k <= counts[n] for n, k in used.items())


def _pieces_are_whole(docs, pieces, tokenizer):
    """Every id in one piece, ids as the library's, sequences gapless and without padding."""
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        documents.setdefault(p["doc_id"], []).append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    for doc, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(documents[doc], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            part = np.array(ids[at : at + p["length"]], "<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part) if "ids_crc32" in p else bytes(p["ids"]) == part
            at += p["length"]
        assert at == len(ids)


def test_packing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = [r.asDict() for r in QUERIES["op3_packing"](spark, FOLDER).collect()]
    _pieces_are_whole([tuple(r) for r in docs], rows, Tokenizer.from_file(WORDS))


def test_packing_of_odd_rows(spark, odd_rows):
    docs = odd_rows.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = [r.asDict() for r in packing.pack_documents(docs, WORDS).collect()]
    _pieces_are_whole([(r["doc_id"], r["text"]) for r in docs.collect()], rows, Tokenizer.from_file(WORDS))
    assert packing.pack_documents(odd_rows.where("doc_id is null or doc_id = 7"), WORDS).agg(F.sum("length")).first()[0] > 5
    assert packing.pack_documents(odd_rows.limit(0), WORDS).count() == 0


def test_equal_lengths_leave_no_padding():
    packer = packing._Packer(4096, 0)
    for i in range(50):
        packer.add(i, np.full(3000, i, np.uint16))
    packer.close()
    used = {}
    for _, _, length, _, sequence, _, _ in packer.out:
        used[sequence] = used.get(sequence, 0) + length
    assert sum(used.values()) == 150_000 and all(n & (n - 1) == 0 for n in used.values())


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain(text):
    def holds(kind, s):
        digits = [int(c) for c in s if c.isdigit()]
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    kinds = list(BASE)
    return sorted((m.start(), kinds.index(k), m.end()) for k in kinds for m in re.finditer(BASE[k], text) if holds(k, m[0]))


@given(st.one_of(st.text("a@.b_-%1", max_size=30), st.text("0129. -+(", max_size=40), st.text("1.25", max_size=30)))
@settings(max_examples=600, deadline=None)
def test_base_spans_are_the_plain_patterns(text):
    kinds = list(BASE)
    assert [(s, kinds.index(k), e) for k, s, e, _ in personal_data.find(text) if k in BASE] == _plain(text)


def test_checksums_and_context():
    find = lambda t: [(k, t[s:e]) for k, s, e, _ in personal_data.find(t)]
    assert find("pay DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert find("pay DE88 3704 0044 0532 0130 00.") == []
    assert find("ssn 123-45-6789") == [("ssn", "123-45-6789")] and find("lot 123-45-6789") == []
    assert find("call (555) 123-4567") == [("local_phone", "(555) 123-4567")] and find("lot (555) 123-4567") == []
    assert find("card 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111")] and find("4111 1111 1111 1112") == []


@pytest.mark.parametrize("text", ["1" * 10**6, "1." * 10**6, "+" * 10**6, "+1" + "." * 10**6, "a" * 10**6 + "@", "a@" * 10**6, "DE89" * 10**5])
def test_long_texts_take_no_square_time(text):
    personal_data.find(text)


def test_personal_data_query_and_masks(spark, odd_rows):
    docs = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    kinds = list(BASE)
    for r in QUERIES["op4_personal_data"](spark, FOLDER).collect():
        plain = _plain(docs[r["doc_id"]])
        assert [r[f"n_{k}"] for k in kinds] == [sum(x[1] == i for x in plain) for i in range(4)]
        assert r["spans"] == ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in plain)
    assert personal_data.find_personal_data(odd_rows).where("size(spans) > 0").count() == 0
    mail = spark.createDataFrame([(1, "to a@b.org now", "x"), (2, None, "y")], "doc_id long, text string, `text.` string")
    assert [tuple(r) for r in personal_data.mask_personal_data(mail).orderBy("doc_id").collect()] == [(1, "to [EMAIL] now", "x"), (2, None, "y")]


def test_a_word_is_held_once():
    words, text = WordIds(WORDS), "the cat the. Cat THE... the"
    assert words.ids(text).tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    # the, cat, the., Cat, THE... and two runs of signs
    assert len(words.parts) + len(words.words) == 7
