import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from logloom.llm import decontamination, line_dedup, packing, queries

from . import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 0]


def check_pieces(rows, expected, capacity):
    """rows hold the token ids; expected: {doc_id: ids}. Returns the share of padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = list(struct.unpack(f"<{r['length']}I", r["token_ids"]))
        assert r["ids_crc32"] == zlib.crc32(bytes(r["token_ids"])) and r["length"] > 0
        pieces[r["doc_id"]].append((r["start"], ids, r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, found in pieces.items():
        found.sort()
        assert [x for _, ids, _ in found for x in ids] == expected[doc_id]
        assert {n for _, _, n in found} == {len(expected[doc_id])}
        assert [s for s, _, _ in found] == [sum(len(i) for _, i, _ in found[:k]) for k in range(len(found))]
    assert set(pieces) == set(expected)
    padding = total = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / total


@pytest.mark.parametrize("capacity", [1024, 64])
def test_packing(documents, no_documents, capacity):
    expected = {r["doc_id"]: ids_of(r["text"]) for r in documents.select("doc_id", "text").collect()}
    rows = packing.pack(documents, PATH, capacity, min(64, capacity // 4)).collect()
    assert check_pieces(rows, expected, capacity) < 0.02
    assert packing.pack(no_documents, PATH).count() == 0


def test_pieces_of_a_document():
    for n in [*range(1, 2100), 100_000]:
        lengths = packing.piece_lengths(n)
        assert sum(lengths) == n and min(lengths) > 0 and max(lengths) <= 1024
        assert all(x <= packing.TAIL or 1024 - x * (1024 // x) < 1024 // x for x in lengths)


def test_capacity_must_be_a_power_of_two(documents):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(documents, PATH, 1000)


@pytest.mark.parametrize("text", ["a  b", " a", "a ", "x\n\ny", "it's <|endoftext|> here", "漢字 and “quotes” " * 900, "‍ \x85 \x1c a", "é" * 5_000, "a b " * 3_000])
def test_ids_are_those_of_the_tokenizer(text):
    assert packing.TokenIds.of(PATH).encode(text) == struct.pack(f"<{len(ids_of(text)) - 1}I", *ids_of(text)[:-1])


def test_pipeline(spark):
    """Each stage but the learned one in plain Python; that one by the scores of its query."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r["doc_id"] for r in queries.op1_toxicity(spark, SF).where("predicted = 1").select("doc_id").collect()}
    rows = [r for r in documents.select("doc_id", "source", "text").orderBy("doc_id").collect() if r["doc_id"] not in toxic]
    texts = brute.without_boilerplate([(r["source"], r["text"]) for r in rows], line_dedup.RATIO, line_dedup.LEAST_PAGES)
    group = brute.components(texts)
    windows = brute.benchmark_windows([tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])
    expected = {}
    for i, (row, text) in enumerate(zip(rows, texts)):
        n_words, n_hit, _ = brute.hits(text, windows)
        if group[i] == i and not (n_hit and 20 * n_hit >= n_words):
            expected[row["doc_id"]] = ids_of(text)
    assert 0 < len(expected) < documents.count()
    assert check_pieces(corpus_pipeline.run(spark, SF).collect(), expected, 1024) < 0.02
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == documents.columns
    assert decontamination.WINDOW == 13
