import random
from collections import Counter, defaultdict
from hashlib import sha256

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from logloom.llm import curve_packing, piece_tokens, rans, token_files
from logloom.llm.arrays import blocks
from logloom.llm.byte_tokens import Encoder
from logloom.plans.scratch import scratch_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BYTES)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def odd_texts(n=4000):
    rng = random.Random(1)
    parts = ["a", "the", "ing", "'s", " ", " ", "  ", "\n", "\t", "é", "à", "×", "1", "22", ".", " ", " ", "!", "漢",
             "\x1c", "😀", "́", "​", "﻿", "あ", "▁", "abab", "　"]
    return [t for _, t in brute.ODD] + ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]


def test_byte_ids_are_the_library_s(library):
    encoder = Encoder(BYTES)
    for rows, offsets, data in blocks([pa.record_batch({"text": pa.array(odd_texts())})], "text", 5000):
        ids, firsts = encoder.encode(offsets, data)
        for n, text in enumerate(rows.column("text").to_pylist()):
            assert ids[firsts[n]: firsts[n + 1]].tolist() == library(text)


def test_pieces_are_the_library_s():
    coder = piece_tokens.Coder(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for rows, offsets, data in blocks([pa.record_batch({"text": pa.array(odd_texts())})], "text", 5000):
        ids, firsts = coder.encode(offsets, data)
        for n, text in enumerate(rows.column("text").to_pylist()):
            assert ids[firsts[n]: firsts[n + 1]].tolist() == library.encode(text or "", add_eos=True)


@pytest.mark.parametrize("ids", [
    np.zeros(1, int), np.zeros(9000, int), np.arange(50_257), np.random.default_rng(0).zipf(1.3, 300_000) % 50_000,
])
def test_blocks_round_trip(ids):
    table = rans.Table.of(ids)
    assert table.frequencies.sum() == 1 << rans.TABLE_BITS and table.frequencies.min() >= 1
    states, words = rans.encode_block(ids, table)
    assert (rans.decode_block(len(ids), states, words, table) == ids).all()
    if len(words):
        words = words.copy()
        words[0] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            if (rans.decode_block(len(ids), states, words, table) != ids).any():
                raise ValueError("damaged")


def test_token_files(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "TASK_BYTES", 300_000)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), path, BYTES)
    assert spark.read.parquet(path).count() > 5
    got = {r["doc_id"]: r for r in token_files.read_token_files(spark, path).collect()}
    docs, start = brute.read("documents").sort_values("doc_id"), 0
    for i, text in zip(docs.doc_id, docs.text):
        ids = library(text)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), brute.crc(ids))
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids
        start += len(ids)


def test_token_files_of_odd_rows(spark, library):
    docs = brute.frame(spark, brute.ODD)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs, path, BYTES)
    got = token_files.read_token_files(spark, path).collect()
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == Counter((i, brute.crc(library(t))) for i, t in brute.ODD)
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(docs.limit(0), path, BYTES)
    assert token_files.read_token_files(spark, path).count() == 0


def check_packing(pieces, documents):
    by_document, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_document[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for i, ids in documents.items():
        at = 0
        for p in sorted(by_document.pop(i), key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == brute.crc(ids[at: at + p["length"]])
            assert p["ids"] is None or np.frombuffer(p["ids"], "<u4").tolist() == ids[at: at + p["length"]]
            at += p["length"]
        assert at == len(ids)
    assert not by_document
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == 1024 or at & (at - 1) == 0


def test_packing(spark, library, monkeypatch):
    monkeypatch.setattr(curve_packing, "TASK_BYTES", 500_000)
    docs = brute.read("documents")
    got = curve_packing.pack_along_curve(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), BYTES)
    check_packing(got.collect(), {i: library(t) for i, t in zip(docs.doc_id, docs.text)})


def test_packing_of_odd_rows(spark, library):
    rows = [(n, t) for n, (_, t) in enumerate(brute.ODD)]
    docs = brute.frame(spark, rows)
    check_packing(curve_packing.pack_along_curve(docs, BYTES).collect(), {i: library(t) for i, t in rows})
    repeated = curve_packing.pack_along_curve(brute.frame(spark, brute.ODD), BYTES).collect()
    assert sum(p["length"] for p in repeated) == sum(len(library(t)) for _, t in brute.ODD)
    assert curve_packing.pack_along_curve(docs.limit(0), BYTES).count() == 0


def test_the_curve_is_one_path():
    """Neighbours on the curve are neighbours on the grid, and no point is left out."""
    side = 1 << 2
    axes = np.stack(np.meshgrid(*[np.arange(side)] * curve_packing.DIMENSIONS), -1).reshape(-1, curve_packing.DIMENSIONS)
    keys = curve_packing._along_curve(axes.astype(np.uint32))
    path = axes[np.argsort(keys)]
    assert len(set(keys.tolist())) == len(axes)
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_pieces_of_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = brute.frame(spark, brute.ODD)
    got = piece_tokens.encode_pieces(docs, PIECES).collect()
    want = Counter()
    for i, text in brute.ODD:
        ids = library.encode(text or "", add_eos=True)
        want[i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got) == want
    digests = piece_tokens.encode_pieces(docs, PIECES, digests=True).filter("doc_id = 1").first()
    ids = library.encode(brute.ODD[0][1], add_eos=True)
    assert digests["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert digests["decoded_sha256"] == sha256(library.decode(ids).encode()).hexdigest()
    assert piece_tokens.encode_pieces(docs.limit(0), PIECES).count() == 0


def test_long_words_merge_as_in_the_library():
    merges = piece_tokens.Merges(PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    words = ["a" * 5000, "abab" * 700, "=" * 333, "the" * 200, "é" * 50 + "漢" * 20]
    ids, lengths = merges.encode_words([" " + w for w in words])
    parts = np.split(ids, np.cumsum(lengths)[:-1])
    assert [p.tolist() for p in parts] == [library.encode(w) for w in words]
