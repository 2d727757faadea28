import random

import pytest
from pyspark.sql import functions as F

from logloom.functions import words

from . import brute

random.seed(7)
EDGES = [0, 1, 255, 256, 10**8, 2**31 - 1, 2**31, 2**63 - 1, 2**63, 2**64 - 1, 2**64, 2**120 - 1, 2**120, 2**124,
         10**38 - 1, 10**38, 2**127, 2**128 - 1, 2**128, 2**255 - 1, 2**255, 2**256 - 1]
VALUES = EDGES + [random.getrandbits(random.randint(1, 256)) for _ in range(400)]


def test_unsigned(spark, ansi):
    rows = spark.createDataFrame([(str(v), v.to_bytes(32, "big")) for v in VALUES], "v string, w binary")
    w = F.col("w")
    out = rows.select(
        "v",
        words.uint_text(w).alias("text"),
        words.uint_decimal(w).cast("string").alias("dec"),
        words.uint_bigint(w).alias("big"),
        words.uint_int(w).alias("small"),
        words.boolean(w).alias("flag"),
    )
    for r in out.collect():
        v = int(r["v"])
        assert r["text"] == str(v)
        assert r["dec"] == (str(v) if v < 10**38 else None)
        assert r["big"] == (v if v < 2**63 else None)
        assert r["small"] == (v if v < 2**31 else None)
        assert r["flag"] == (v != 0)


@pytest.mark.parametrize("bits", [8, 64, 128, 256])
def test_signed_topics(spark, ansi, bits):
    rows = spark.createDataFrame([(f"{v:064x}",) for v in VALUES], "t string")
    out = rows.select("t", words.finish_text(words.topic_text(F.col("t"), f"int{bits}")).alias("x"))
    for r in out.collect():
        assert r["x"] == brute.topic_value(r["t"], f"int{bits}")


TOPICS = ["0x" + "12" * 32, "12" * 32, "0x", "", "0x1", "0xABC", "0x" + "0" * 70 + "7", "0x" + "0" * 10 + "f" * 64,
          "0x" + "00" * 12 + "AbCdEf" + "00" * 17, "0xzz", "0x-5", "0x" + "1" * 65, "0x" + "f" * 71, "0x1" + "0" * 64, "0x" + "9" * 200, "0xabc" + "0" * 80 + "1"]


@pytest.mark.parametrize("kind", ["address", "bool", "uint256", "uint16", "int256", "int8", "bytes4", "bytes32", "bytes", "string"])
def test_topics(spark, ansi, kind):
    topic = F.col("t")
    out = spark.createDataFrame([(t,) for t in TOPICS], "t string").select(
        "t",
        words.is_number_topic(topic).alias("ok"),
        words.finish_text(words.topic_text(topic, kind)).alias("x"),
    )
    for r in out.collect():
        try:
            expected = brute.topic_value(r["t"], kind)
        except brute.Bad:
            assert not r["ok"]
            continue
        assert r["x"] == expected, (r["t"], kind)


WORDS = [0, 1, 2, 255, 256, 2**16 - 1, 2**16, 2**160 - 1, 2**160, 2**255, 2**256 - 1, 2**256 - 128, 2**256 - 129,
         0xDEADBEEF << 224, (0xDEADBEEF << 224) + 1, 127, 128]


@pytest.mark.parametrize("kind", ["address", "bool", "uint8", "uint16", "uint256", "int8", "int256", "bytes4", "bytes32"])
def test_strict_data_words(spark, ansi, kind):
    rows = spark.createDataFrame([(v.to_bytes(32, "big"),) for v in WORDS], "w binary")
    strict = words.is_strict_word(F.col("w"), kind)
    out = rows.select(
        "w",
        (F.lit(True) if strict is None else strict).alias("ok"),
        words.finish_text(words.data_text(F.col("w"), kind)).alias("x"),
    )
    for r in out.collect():
        try:
            expected = brute.data_value(bytes(r["w"]), kind)
        except brute.Bad:
            assert not r["ok"], (r["w"], kind)
            continue
        assert r["ok"] and r["x"] == expected, (r["w"], kind)


def test_data_bytes(spark, ansi):
    cases = {"0x": b"", "": b"", None: b"", "0xAb12": b"\xab\x12", "ab12": b"\xab\x12", "0x123": None, "zz": None,
             "0X12": None, "a b ": None, "é1": None, "0x0x12": None}
    out = spark.createDataFrame([(k,) for k in cases], "d string").select("d", words.data_bytes(F.col("d")).alias("b"))
    for r in out.collect():
        assert (bytes(r["b"]) if r["b"] is not None else None) == cases[r["d"]], r["d"]


LONG = [random.getrandbits(4 * n) | 1 << (4 * n - 1) for n in (*range(62, 70), *range(94, 99), *range(126, 131), 160, 300)]
LONG += [1 << 256, (1 << 256) + 10**40, 10**96, 10**120 - 1, (1 << 320) - 1, (1 << 384) - 1, (1 << 512) - 1, 1 << 512, 17 << 256, (1 << 255) + 1, (1 << 256) - 10**50]


@pytest.mark.parametrize("kind", ["uint256", "int256", "int128", "int64", "int56", "int8"])
def test_numbers_of_any_length(spark, ansi, kind):
    topics = [f"0x{v:x}" for v in LONG + VALUES] + [f"0x{'0' * 90}{v:X}" for v in LONG] + [f"0x{(1 << 256) - v:x}" for v in VALUES if v]
    topics += [f"{2**n + d:x}" for n in (7, 8, 55, 56, 63, 64, 127, 128) for d in (-1, 0, 1)]
    rows = spark.createDataFrame([(t,) for t in topics], "t string").withColumn("x", words.topic_text(F.col("t"), kind))
    for r in rows.withColumn("x", words.finish_text(F.col("x"))).collect():
        assert r["x"] == brute.topic_value(r["t"], kind), (r["t"], kind)


def _largest_method(rows):
    """Bytes of the largest method of whole-stage code."""
    code = rows._jdf.queryExecution().debug().codegenToSeq()
    return max((int(code.apply(i)._3().maxMethodCodeSize()) for i in range(code.size())), default=0)


def test_plain_topics_meet_no_lambda(spark):
    """A lambda is interpreted: only marked numbers are to meet one."""
    rows = spark.createDataFrame([("0x1",)], "t string")
    for kind in ("uint256", "uint8", "int256", "int8", "bool"):
        assert "lambda" not in rows.select(words.topic_text(F.col("t"), kind))._jdf.queryExecution().optimizedPlan().toString()


def test_word_values_of_own_rows(spark, tmp_path):
    """Repeated and missing keys; every step is code that HotSpot compiles (methods up to 8,000 bytes)."""
    from workload.queries import word_values

    keys = [0, 1, 2, 5, 5, 127, 128, 255, 256, 1000002, 1000003, 2**32 - 1, 10**9 + 7, None]
    spark.createDataFrame([(k,) for k in keys], "event_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    rows = word_values(spark, str(tmp_path))
    assert _largest_method(rows) <= 8000
    found = sorted((tuple(r) for r in rows.collect()), key=lambda r: -1 if r[0] is None else r[0])
    expected = [(None,) * 9] + [
        (
            k, f"0x{k * 31 + 7:040x}", str(k % 3 > 0), str(k % 1000003 * 2**64 + k * 97), str(-1 - k), str(k % 256 - 256 * (k % 256 >= 128)),
            f"0x{k:08x}", str((k + 1) << 256), f"0x{k:064x}",
        )
        for k in sorted(k for k in keys if k is not None)
    ]
    assert found == expected
