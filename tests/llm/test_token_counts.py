import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logloom.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def sized(text):
    return len(text.encode()), len(Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids)


def in_order(rows):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows.collect()), key=repr)


def test_every_character():
    """Between letters, digits and marks, each code point leads to the library's number of tokens."""
    pre, library = token_counts.PreTokenizer(PATH), Tokenizer.from_file(PATH)
    texts = [f"a{chr(c)}B 1{chr(c)}!'S" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for text, ids in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        special, found = pre.frequencies(text)
        assert special + sum(n * pre.pieces(t) for t, n in found.items()) == len(ids.ids), repr(text)


def test_special_strings_and_mixed_texts():
    pre, library, rng = token_counts.PreTokenizer(PATH), Tokenizer.from_file(PATH), random.Random(5)
    signs = [chr(c) for c in range(0x250)] + list("  \n\t'sStTdDmM!?.,12") * 9 + ["<|endoftext|>", "<|startoftext|>", "J̌", "漢", "Σ", "İ", "'LL", "<|end"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 30)))
        special, found = pre.frequencies(text)
        assert special + sum(n * pre.pieces(t) for t, n in found.items()) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


@pytest.mark.parametrize("head_rows", [0, 40, token_counts.HEAD_ROWS])
def test_documents(spark, documents, no_documents, head_rows):
    """By a shuffle alone, by both ways, and by a broadcast alone."""
    extra = spark.createDataFrame([(None, "One<|endoftext|>two"), (None, "One<|endoftext|>two"), (7, "<|startoftext|>"), (8, "İ J̌ 漢字")], "doc_id long, text string")
    rows = documents.select("doc_id", "text").union(extra)
    clashing = rows.withColumns({name: F.lit("x") for name in ("row", "token", "tokens", "count", "pieces", "n_bytes")})
    expected = sorted(((r["doc_id"], *sized(r["text"] or "")) for r in rows.collect()), key=repr)
    assert in_order(token_counts.count_tokens(clashing, PATH, head_rows)) == expected
    assert token_counts.count_tokens(no_documents, PATH, head_rows).count() == 0


def test_each_pre_token_once_and_the_broadcast_bound(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    texts = token_counts.pre_token_frequencies(documents, PATH)
    dictionary = token_counts.piece_counts(texts.select(F.inline(F.arrays_zip("tokens", "counts")).alias("token", "count")), PATH).cache()
    assert dictionary.count() == dictionary.select("token").distinct().count()
    for most in (1, 50, 300):
        assert dictionary.where(F.col("n_docs") >= token_counts.head_bound(dictionary, most)).count() <= most
    library = Tokenizer.from_file(PATH)
    expected = sum(len(e.ids) for e in library.encode_batch([r["text"] for r in documents.collect()], add_special_tokens=False))
    assert token_counts.count_tokens(documents, PATH).agg(F.sum("n_tokens")).first()[0] == expected


def test_other_files_go_through_the_library(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = spark.createDataFrame([(1, "Hello  world, it's <|endoftext|> 漢字\n"), (2, "")], "doc_id long, text string")
    library = Tokenizer.from_file(path)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(rows, path).collect()}
    assert got == {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) for r in rows.collect()}
