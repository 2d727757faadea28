import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import fill_in_middle as fim


def changed(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by slices of the list of lines."""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or re.search("<[PSM]>", text):
        return len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    form, output = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return len(lines), form, len(p), len(m), output


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 255, 256, 257, 5000])
@pytest.mark.parametrize("fanout", [2, 16])
def test_every_rank_of_the_skip_list(n, fanout):
    widths = np.random.default_rng(n).integers(1, 90, n)
    units = fim.SkipList(widths, fanout)
    total = np.concatenate([[0], np.cumsum(widths)])
    assert [units.code_points(r) for r in range(n + 1)] == total.tolist()
    assert sum(len(lane) for lane, _ in units.lanes) <= 2 * n + 20


@pytest.mark.parametrize("text", ["", "\n", "\n\n", "a", "a\n", "a\nb", "\na", "é\n\U0001f600x\n漢", "a\r\nb c\x0b\n"])
def test_lines(text):
    assert fim.line_widths(text).tolist() == [len(x) for x in re.findall(r"[^\n]*\n|[^\n]+", text)]


def test_documents(spark, documents, no_documents):
    extra = spark.createDataFrame(
        [(None, "a\nb\nc"), (None, "a\nb\nc"), (500, "x<M>y\nz"), (501, "<\n<P"), (502, "a\n" * 90_000), (502, None), *[(k, "<\nS>\nM\n>\n<S\né\n" * 3) for k in range(600, 640)]],
        "doc_id long, text string",
    )
    rows = documents.select("doc_id", "text").union(extra)
    got = fim.fill_in_middle(rows.withColumn("output", F.lit(1)).withColumn("form", F.lit(2)))
    got = got.withColumn("restored", fim.restored(F.col("output"), F.col("form"))).collect()
    expected = sorted(((r["doc_id"], *changed(r["doc_id"], r["text"] or ""), r["text"] or "") for r in rows.collect()), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == expected
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(no_documents).count() == 0


def test_share_of_changed_documents(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a\nb").alias("text"))
    forms = {r["form"]: r["count"] for r in fim.fill_in_middle(rows, percent=30, spm_percent=0).groupBy("form").count().collect()}
    assert set(forms) == {"plain", "psm"} and 500 < forms["psm"] < 700
