import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logloom.llm import source_divergence as audit
from logloom.llm.words import string_buffers

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(rows, top=200):
    docs, found, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        def difference(p, q):
            return (p - q) * (p - q) // q

        p = shares(found[lang, source])
        pairs = [(other, sum(difference(p[t], q) for t, q in shares(found[lang, other]).items())) for g, other in groups if g == lang and other != source]
        q = shares(sum((found[lang, s] for g, s in groups if g == lang), Counter()))
        words = [(t, difference(p[t], q[t])) for t in kept if found[lang, source][t] and p[t] > q[t]]
        for part, items in (("pair", pairs), ("term", words)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(items, 1) if part == "pair" or rank <= top]
    return sorted(out)


def rows_of(audit_tables, **sizes):
    pairs, words = audit_tables.pairs(**sizes), audit_tables.top_terms()
    out = []
    for part, frame in (("pair", pairs), ("term", words)):
        out += [(r["lang"], r["source"], part, r["item"], r["value"], r["rank"]) for r in frame.collect()]
    return sorted(out)


def test_runs_are_the_sorted_distinct_words():
    rng = random.Random(2)
    stems = ["abcdefgh", "abcdefghabcdefgh", "abcdefghabcdefghi", "a", "ab", "é" * 4, "é" * 9, "漢字", "zzzzzzz", "zzzzzzzz", "zzzzzzzzz", "Abcdefgh", "x" * 300, "x" * 301]
    texts = [rng.choice(["", " ", "-", "_1"]).join(rng.choice(stems) + rng.choice(["", " ", "\n", "9"]) for _ in range(rng.randint(0, 40))) for _ in range(60)] + ["", None, "ab", "cd"]
    shard = audit.Shard(*string_buffers(pa.array(texts)))
    order, heads = shard.sorted_runs()
    words = [shard.word(i) for i in order.tolist()]
    assert words == sorted((t for text in texts for t in terms(text)), key=str.encode)
    assert [words[i] for i in heads.tolist()] == sorted(set(words), key=str.encode)
    assert Counter(shard.docs.tolist()) == Counter({i: len(terms(t)) for i, t in enumerate(texts) if terms(t)})


def corpus(seed=4, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéXYZ") for _ in range(rng.randint(1, 20))) for _ in range(120)]
    rows = []
    for i in range(n):
        source = rng.choice(["s0"] * 4 + [f"s{k}" for k in range(12)] + [None])
        bias = words[: 20 + 5 * int((source or "s0")[1:])]
        rows.append((rng.choice(["en", "en", "de", None]), source, " ".join(rng.choice(bias) for _ in range(rng.randint(0, 40)))))
    rows += [("en", "empty", None), ("en", "digits", "12 34 __"), ("xx", "one", "only only"), ("xx", "two", "other"), ("yy", "alone", "same same"), ("yy", "alone", "same"), ("yy", "alone", "Same SAME")]
    return rows + rows[:5]


@pytest.mark.parametrize("shard_bytes,block,bucket", [(16 << 20, 64, 10_000), (300, 3, 25), (1, 1, 1000)])
def test_documents(spark, shard_bytes, block, bucket):
    rows = corpus()
    documents = spark.createDataFrame([(*r, 1, 2, "v", 3, "t") for r in rows], "lang string, source string, text string, n int, p int, term string, rank int, item string").repartition(3)
    tables = audit.Audit(documents, shard_bytes=shard_bytes)
    assert rows_of(tables, block_sources=block, bucket_rows=bucket) == expected(rows)


def test_counts_of_shards_add_up(spark, documents):
    rows = [(r["lang"], r["source"], r["text"]) for r in documents.collect()]
    found, docs = Counter(), Counter()
    for lang, source, text in rows:
        found.update((lang, source or "", t) for t in terms(text))
        docs.update({(lang, source or "", t) for t in terms(text)})
    for size in (16 << 20, 2000):
        got = {(r["lang"], r["source"], r["term"]): (r["n"], r["n_docs"]) for r in audit.term_counts(documents, size).collect()}
        assert got == {k: (found[k], docs[k]) for k in found}


def test_shared_fixture_and_empty_table(documents, no_documents):
    rows = [(r["lang"], r["source"], r["text"]) for r in documents.collect()]
    got = sorted(tuple(r) for r in audit.audit(documents).collect())
    assert got == expected(rows)
    assert audit.audit(no_documents).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    counts = spark.createDataFrame([(123_456_789_012_345, 987_654_321_098_765, 77)], "n long, total long, terms long")
    got = counts.select(audit._share(F.col("n"), F.col("total"), F.col("terms"))).first()[0]
    assert got == 1 + 10**9 * 123_456_789_012_346 // (987_654_321_098_765 + 77)
