"""Token files and BPE against the library and plain round trips."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import ODD
from roomtrace.llm import token_files as TF, trie_bpe as TB
from roomtrace.session import work_dir

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
byte_library, word_library = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
TRICKY = ["<|endoftext|>", " ", "  ", "\n", "'s", "don't", "É", "ß", "Σ", "İ", "é", "́", "你好", "🙂", "x" * 60, "12", "½", " ", "\x1c", ".,", "The"]
texts = st.lists(st.one_of(st.sampled_from(TRICKY), st.text(max_size=6)), max_size=12).map("".join)


def byte_ids(text):
    return byte_library.encode(text, add_special_tokens=False).ids


def word_ids(text):
    return word_library.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts)
def test_bpe_is_the_library_s(text):
    ids, counts = TB.encoder(BYTE).ids([text])
    assert ids.tolist() == byte_ids(text) and counts.tolist() == [len(ids)]
    assert TB.encoder(BYTE).merges.text_of(ids) == byte_library.decode(byte_ids(text), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_word_ids_are_the_library_s(text):
    assert TF.token_ids([text], WORD)[0].tolist() == word_ids(text)


def test_long_texts_in_pieces(monkeypatch, texts):
    monkeypatch.setattr(TB, "PIECE", 50)
    monkeypatch.setattr(TB, "MANY", 20)
    held = list(texts.values())[:60]
    ids, counts = TB.encoder(BYTE).ids(held)
    assert np.split(ids, np.cumsum(counts)[:-1])[7].tolist() == byte_ids(held[7])
    assert counts.tolist() == [len(byte_ids(t)) for t in held]


def test_bpe_query(answer, texts):
    got = {r["doc_id"]: r for r in answer("op7_bpe")}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ids = byte_ids(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(byte_library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_odd_rows_through_bpe(odd, empty):
    encoded = TB.encode(odd, BYTE)
    got = sorted((str(r.doc_id), r.ids, r.decoded) for r in encoded.collect())
    assert got == sorted((str(i), byte_ids(t or ""), t or "") for i, t in ODD)
    back = sorted((str(r.doc_id), r.text) for r in TB.decode(encoded, BYTE).collect())
    assert back == sorted((str(i), t or "") for i, t in ODD)
    assert TB.encode(empty, BYTE).count() == 0


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=50))
def test_blocks_of_ids_round_trip(values):
    control, data = TF.pack_ids(np.array(values, np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert TF.unpack_ids(control, data, len(values)).tolist() == values


def test_token_file_query(answer, texts):
    got = {r["doc_id"]: r for r in answer("op3_token_files")}
    start = 0
    for i in sorted(texts):
        ids = [*word_ids(texts[i]), TF.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    assert len(got) == len(texts)


def test_odd_rows_through_files(spark, odd, empty):
    folder = work_dir(spark, "odd")
    TF.write(odd, folder, WORD)
    got = TF.read(spark, folder).orderBy("start").collect()
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert sorted((str(r.doc_id), np.frombuffer(r.tokens, "<u4").tolist()) for r in got) == sorted(
        (str(i), [*word_ids(t or ""), TF.END_ID]) for i, t in ODD
    )
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    folder = work_dir(spark, "none")
    TF.write(empty, folder, WORD)
    assert TF.read(spark, folder).count() == 0


def test_common_ids_are_short(spark, odd):
    folder = work_dir(spark, "ranks")
    TF.write(odd, folder, WORD)
    sizes = spark.read.parquet(f"{folder}/blocks").select(F.sum(F.length("data")), F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()
    assert sizes[0] == sizes[1]  # fewer than 256 ids: a byte each
