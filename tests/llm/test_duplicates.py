from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import decontamination, near_dup, phrase_dedup
from logloom.llm.bit_filter import broadcast_filter
from logloom.llm.components import connected_components

from . import brute
from .conftest import prose


def ordered(df):
    return df.select("doc_id", "text").orderBy("doc_id").collect()


def test_near_duplicates(documents):
    rows = ordered(documents)
    group = brute.components([r["text"] for r in rows])
    got = {r["doc_id"]: r for r in near_dup.near_duplicates(documents).collect()}
    assert len(got) == len(rows)
    for i, row in enumerate(rows):
        found = got[row["doc_id"]]
        assert found["n_shingles"] == len(brute.shingles(row["text"]))
        assert found["component_id"] == rows[group[i]]["doc_id"]
        assert found["kept"] == (found["component_id"] == row["doc_id"])


def test_one_of_each_group_stays(documents):
    rows = ordered(documents)
    group = brute.components([r["text"] for r in rows])
    kept = near_dup.without_near_duplicates(documents.union(documents))
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(rows[g]["doc_id"] for g in set(group))


def test_null_ids_and_chains(spark):
    """A group without ids; a chain whose ends are not alike; a link outside the centre's own."""
    base = prose(11, 100)
    chain = [" ".join(base[5 * i : 70 + 5 * i]) for i in range(5)]
    rows = [(None, "null ids may repeat a text of six words"), (None, "null ids may repeat a text of six words"), (9, "")] + [(20 - i, t) for i, t in enumerate(chain)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)] * 2
    assert {r["component_id"] for r in got if r["doc_id"] and r["doc_id"] > 9} == {16}
    assert near_dup.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == 3


def test_rows_without_words_stay(spark):
    """Null ids and blank texts share a key, but not their other columns; a row twice, with its id, is one."""
    rows = [(None, None, "en"), (None, None, "en"), (None, None, "de"), (None, " ", "fr"), (None, " ", "fr"), (1, "", "en"), (1, "", "de"), (1, "", "de"), (2, "\t", "en")]
    kept = near_dup.without_near_duplicates(spark.createDataFrame([*rows, (3, "two words", "en"), (3, "two words", "en")], "doc_id long, text string, lang string"))
    assert Counter(map(tuple, kept.collect())) == Counter([*rows[:7], rows[8], (3, "two words", "en")])


def test_groups_of_many_similarities(spark):
    """A passage shared in different shares makes similarities on both sides of the threshold."""
    passage = prose(12, 120)
    rows = [(i, " ".join(prose(100 + i, i % 45) + passage)) for i in range(160)]
    expected = brute.components([t for _, t in rows])
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(expected))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(1)
    universe = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for overlap in (0.75, 0.9):
        shared = int(2000 * 2 * overlap / (1 + overlap))
        a, b = universe[:2000], universe[2000 - shared : 4000 - shared]
        sketches = near_dup.odd_sketches(near_dup.min_hashes(np.concatenate([a, b]), np.array([0, 2000, 4000])))
        z = int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())
        estimate = 1 + near_dup.SKETCH_BITS / (4 * near_dup.SAMPLES) * np.log(1 - 2 * z / near_dup.SKETCH_BITS)
        assert abs(estimate - overlap) < 0.12 and z <= near_dup.largest_distance()


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 101)], "a int, b int")
    got = {r["node"]: r["label"] for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_bit_filter_has_no_false_negatives(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(-(1 << 63), 1 << 63, 500, dtype=np.int64)
    held = broadcast_filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), bits=20).value
    assert held.may_have(keys.view(np.uint64)).all()
    assert held.may_have(rng.integers(0, 1 << 63, 2000, dtype=np.uint64)).mean() < 0.01


def test_recurring_passages(documents):
    rows = ordered(documents)
    expected = brute.recurring_removed([r["text"] for r in rows])
    got = {r["doc_id"]: r for r in phrase_dedup.remove_recurring(documents).collect()}
    for row, (n_words, n_removed, text) in zip(rows, expected):
        found = got[row["doc_id"]]
        assert (found["n_words"], found["n_removed"], found["text"]) == (n_words, n_removed, text)
        assert sum(s["last"] - s["first"] + 1 for s in found["removed"]) == n_removed


def test_two_characters_a_word_find_the_same(documents, monkeypatch):
    expected = {r["doc_id"]: r["text"] for r in phrase_dedup.remove_recurring(documents).collect()}
    column = documents.select("doc_id", "text").orderBy("doc_id").toArrow()
    monkeypatch.setattr(phrase_dedup, "_ONE_CHARACTER", 0)
    assert phrase_dedup._as_text(np.array([0, 70_000, 3]), 2) != phrase_dedup._as_text(np.array([0, 70_000, 4]), 2)
    for chunk in phrase_dedup.chunks(column.column("text").combine_chunks(), phrase_dedup.NOT_WHITE, False):
        places = []
        for d in range(chunk.n_docs):
            n = chunk.doc_words[d + 1] - chunk.doc_words[d]
            starts = np.arange(max(0, n - 34))
            checks = phrase_dedup.window_keys(chunk, starts + chunk.doc_words[d])[1] if len(starts) else []
            places.append(np.array([int(s) << 32 | int(c) & 0xFFFFFFFF for s, c in zip(starts, checks)] if n < 200 else [], dtype=np.int64))
        covered = phrase_dedup._located(chunk, places, 35)
        assert covered.any() and len(covered) == len(chunk.hashes)
    assert expected


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, words string")


@pytest.mark.parametrize("block", [200_000, 3])
def test_decontamination(spark, documents, block):
    passage, base = prose(3, 60), prose(1, 120)
    rows = [(1, " ".join(passage[10:40])), (2, "ONE, two: three!"), (3, " ".join(base[50:63])), (10, " ".join(base[55:75])), (4, None), (5, "..."), (None, "漢字"), (1, " ".join(passage[10:40]))]
    windows = brute.benchmark_windows([r for r in rows])
    hits = decontamination.find_hits(documents, items(spark, [(*r, "x") for r in rows]), windows_per_block=block)
    for r in hits.collect():
        n_words, n_hit, found = brute.hits(r["text"], windows)
        assert (r["n_words"], r["n_hit"]) == (n_words, n_hit)
        assert r["hit_items"] == sorted(str(i) for i in found if i is not None)
        assert sum(s["last"] - s["first"] + 1 for s in r["hit_spans"]) == n_hit


def test_blocks_alive_are_bounded(spark, documents, monkeypatch):
    """A benchmark of many blocks: all but those of the last stage are given up before the rows are asked for."""
    benchmark = spark.createDataFrame([(f"i{k}", " ".join(prose(100 + k, 24, 5_000))) for k in range(20)] + [("long", " ".join(prose(7, 30_000, 5_000)[100:200]))], "item_id string, text string")
    expected = sorted(map(str, decontamination.find_hits(documents, benchmark).select("doc_id", "n_words", "n_hit", "hit_items").collect()))
    held, with_block = [], decontamination._with_block
    monkeypatch.setattr(decontamination, "_with_block", lambda rows, shared: held.append(shared) or with_block(rows, shared))
    found = decontamination.find_hits(documents, benchmark, windows_per_block=17)
    alive = [shared._jbroadcast.isValid() for shared in held]
    assert len(held) > 16 and sum(alive) <= decontamination.BLOCKS_PER_STAGE and not any(alive[: -decontamination.BLOCKS_PER_STAGE])
    assert sorted(map(str, found.select("doc_id", "n_words", "n_hit", "hit_items").collect())) == expected
    assert found.where("n_hit > 0").count() > 0


def test_contaminated_documents_go(spark, documents):
    passage = prose(3, 60)
    rows = [(1, " ".join(passage[10:40]))]
    windows = brute.benchmark_windows(rows)
    kept = decontamination.decontaminate(documents, items(spark, [(*r, "x") for r in rows]))
    assert kept.columns == documents.columns and kept.schema == documents.schema
    expected = []
    for row in ordered(documents):
        n_words, n_hit, _ = brute.hits(row["text"], windows)
        if not (n_hit and 20 * n_hit >= n_words):
            expected.append(row["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == expected and len(expected) < documents.count()


def test_empty_tables(spark, documents, no_documents):
    assert near_dup.near_duplicates(no_documents).count() == 0
    assert near_dup.without_near_duplicates(no_documents).count() == 0
    assert phrase_dedup.remove_recurring(no_documents).count() == 0
    none = items(spark, [])
    assert decontamination.find_hits(no_documents, none).count() == 0
    assert decontamination.find_hits(documents, none).where("n_hit > 0").count() == 0
    assert Counter(decontamination.decontaminate(documents, none).collect()) == Counter(documents.collect())



@pytest.fixture(scope="module")
def equal_rows(spark):
    """4,000 equal rows without an id, over several partitions, and a near text with an id."""
    words = prose(21, 400)
    near = " ".join(words[:200] + ["zz"] + words[201:])
    rows = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(" ".join(words)).alias("text"))
    return rows.union(spark.createDataFrame([(5, near), (6, "alone here")], "doc_id long, text string")).repartition(7).cache(), " ".join(words), near


def test_many_equal_rows_are_one_set(equal_rows):
    rows, text, _ = equal_rows
    signed = near_dup.signatures(rows).where("node is not null").groupBy("node").agg(F.min("row_key").alias("row_key"))
    assert near_dup._sets_of(rows, signed).count() == 3
    found = near_dup.near_duplicates(rows).groupBy("doc_id", "component_id", "kept").count().collect()
    assert {tuple(r) for r in found} == {(None, 5, False, 4000), (5, 5, True, 1), (6, 6, True, 1)}
    assert sorted(r["doc_id"] for r in near_dup.without_near_duplicates(rows).collect()) == [5, 6]


def test_many_equal_rows_recur(equal_rows):
    rows, text, near = equal_rows
    found = phrase_dedup.remove_recurring(rows).groupBy("doc_id", "n_words", "n_removed", "text").count().collect()
    assert {tuple(r) for r in found} == {(None, 400, 400, "", 4000), (5, 400, 399, "zz", 1), (6, 2, 0, "alone here", 1)}
