import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from logloom.operators import (
    check_logs,
    dead_letter_rows,
    dead_letters,
    decode_logs,
    decoded_logs,
    event_counts,
    filter_logs,
    shape,
    table_rows,
    with_target,
)
from logloom.operators.decode import BAD_TOPIC, NOT_DECODED
from logloom.operators.shape import TABLES
from logloom.registry import DEFAULT, Registry, define
from logloom.sources import RAW_SCHEMA
from workload.logs import CDAI, MINT, MORPHO, POOL_V2, WITHDRAW_V2, BORROW_V2, event_logs

from . import brute

SF = "/root/testdata/sf0.001"
A = "00" * 12 + "ab" * 20
U = f"{1000:064x}"


def logs_of(spark, rows):
    """rows: (address, topics, data)."""
    full = [(i, datetime(2024, 1, 1), f"0x{i:064x}", i, a, t, d, date(2024, 1, 1)) for i, (a, t, d) in enumerate(rows)]
    return spark.createDataFrame(full, RAW_SCHEMA)


GOLDEN = [
    ((CDAI, [MINT], "0x" + A + U + U), None),
    ((CDAI, [MINT], "0x" + A + U), NOT_DECODED),  # one word short
    ((CDAI, [MINT], "0x" + A + U + U + "0"), NOT_DECODED),  # odd length
    ((CDAI, [MINT], "0xzz" + A[2:] + U + U), NOT_DECODED),
    ((CDAI, [MINT], None), NOT_DECODED),
    ((CDAI, [MINT], ""), NOT_DECODED),
    ((CDAI, [MINT], A + U + U), None),  # prefix is optional
    ((CDAI, [MINT], "0x" + A + U + U + U), None),  # trailing word
    ((CDAI, [MINT], "0x" + A + "f" * 64 + U), None),
    ((CDAI, [MINT], "0xff" + A[2:] + U + U), NOT_DECODED),  # address padding
    (("0x" + CDAI[2:].upper(), ["0x" + MINT[2:].upper()], "0x" + A + U + U), None),
    ((CDAI, [], "0x" + A + U + U), NOT_DECODED),
    ((CDAI, None, "0x" + A + U + U), NOT_DECODED),
    ((MORPHO, [MINT], "0x" + A + U + U), NOT_DECODED),  # no such route
    ((POOL_V2, [WITHDRAW_V2, "0x" + A, "0x" + A], "0x" + U), None),  # third topic missing
    ((POOL_V2, [WITHDRAW_V2, "0x" + A, None, "0x" + A], "0x" + U), BAD_TOPIC.format(2)),
    ((POOL_V2, [BORROW_V2, "0x" + A, "0x" + A, "0xzz"], "0x" + A + U + U + U), BAD_TOPIC.format(3)),
    ((POOL_V2, [BORROW_V2, "0xzz", "0x1", "0x10000"], "0x" + A + U + U + U), None),  # topics are not checked
    ((POOL_V2, [BORROW_V2, None, "0x1", "0xzz"], "0xzz"), BAD_TOPIC.format(1)),  # first failure is reported
]


def test_golden_logs(spark, ansi):
    decoded = decode_logs(logs_of(spark, [g[0] for g in GOLDEN])).orderBy("block_number").collect()
    for row, ((address, topics, data), error) in zip(decoded, GOLDEN):
        result = row["decode_result"]
        payload, expected_error = brute.decode(address, topics, data)
        assert expected_error == error
        assert result["error"] == error and result["success"] == (error is None)
        assert result["data"] == payload
        assert result["raw_topics"] == (topics if error else None)
        assert result["raw_data"] == (data if error else None)


def test_result_schema(spark):
    schema = decode_logs(logs_of(spark, [GOLDEN[0][0]])).schema["decode_result"].dataType
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("success", "boolean"),
        ("data", "map<string,string>"),
        ("error", "string"),
        ("raw_topics", "array<string>"),
        ("raw_data", "string"),
    ]
    assert not schema["success"].nullable


def _random_logs(n):
    rng = random.Random(3)
    routes = sorted(brute.ROUTES)

    def word(kind):
        if rng.random() < 0.03:
            return f"{rng.getrandbits(256):064x}"
        if kind == "address":
            return f"{rng.getrandbits(160):064x}"
        if kind == "bool":
            return f"{rng.getrandbits(1):064x}"
        size = 256 if kind == "bytes32" else min(rng.choice([8, 40, 64, 100, 130, 256]), brute._width(kind, "uint", 256))
        return f"{rng.getrandbits(size):064x}"

    for _ in range(n):
        contract, topic0 = rng.choice(routes)
        definition = brute.ROUTES[contract, topic0]
        topics = [topic0] + ["0x" + word(kind) for _, kind in definition.topic_fields]
        data = "0x" + "".join(word(kind) for _, kind in definition.data_fields)
        if rng.random() < 0.1:
            topics = topics[: rng.randint(1, len(topics))]
        if rng.random() < 0.1:
            data = data[: rng.randint(0, len(data))]
        if rng.random() < 0.1:
            data = data.upper().replace("0X", "0x")
        yield contract, topics, data


def test_random_logs_against_brute_force(spark):
    rows = list(_random_logs(1500))
    for row in decode_logs(logs_of(spark, rows)).collect():
        payload, error = brute.decode(*rows[row["block_number"]])
        assert row["decode_result"]["error"] == error
        assert row["decode_result"]["data"] == payload


@pytest.mark.parametrize("table", TABLES, ids=lambda t: t.name)
def test_typed_rows_equal_shaped_rows(spark, ansi, table):
    logs = logs_of(spark, list(_random_logs(600)) + [g[0] for g in GOLDEN])
    shaped = shape(decoded_logs(decode_logs(logs)), table)
    typed = table_rows(with_target(logs), table)
    assert shaped.schema == typed.schema
    assert shaped.count() > 0
    assert shaped.exceptAll(typed).isEmpty() and typed.exceptAll(shaped).isEmpty()


def test_dead_letters(spark):
    logs = logs_of(spark, [g[0] for g in GOLDEN])
    by_map, typed = dead_letters(decode_logs(logs)), dead_letter_rows(with_target(logs))
    assert by_map.columns == ["block_number", "block_timestamp", "transaction_hash", "log_index", "date", "address",
                              "error", "raw_topics", "raw_data"]
    assert sorted(by_map.collect(), key=str) == sorted(typed.collect(), key=str)
    assert by_map.count() == sum(error is not None for _, error in GOLDEN)


def test_filter(spark, ansi):
    rows = [
        (CDAI, [MINT], "0x"),
        ("0x" + CDAI[2:].upper(), [MINT], "0x"),
        (MORPHO, [MINT], "0x"),  # both known, not together
        (CDAI, ["0x" + MINT[2:].upper()], "0x"),  # hash is compared as it stands
        ("0x" + "11" * 20, [MINT], "0x"),
        (CDAI, [], "0x"),
        (CDAI, None, "0x"),
        (None, [MINT], "0x"),
    ]
    logs = logs_of(spark, rows)
    assert sorted(r["block_number"] for r in filter_logs(logs).collect()) == [0, 1, 2]
    assert sorted(r["block_number"] for r in filter_logs(logs, assume_lowercase=True).collect()) == [0, 2]


def test_counts_agree(spark):
    decoded = decode_logs(filter_logs(event_logs(spark, SF)))
    counts = {r["table"]: r["n"] for r in event_counts(decoded).collect()}
    assert counts["dead_letter"] == dead_letters(decoded).count()
    for table in TABLES:
        assert counts[table.name] == shape(decoded_logs(decoded), table).count()
    assert sum(counts.values()) == decoded.count()


def test_plan_has_one_broadcast_and_no_shuffle(spark):
    logs = spark.read.schema(RAW_SCHEMA).parquet(_dataset(spark))
    for table in TABLES:
        plan = table_rows(with_target(filter_logs(logs)), table)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastExchange") == 1
        assert "Exchange hashpartitioning" not in plan and "Python" not in plan


def test_lowercase_source_pushes_the_address_filter(spark):
    logs = spark.read.schema(RAW_SCHEMA).parquet(_dataset(spark))
    plan = filter_logs(logs, assume_lowercase=True)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(address" in plan.replace("PushedFilters: [IsNotNull(address), ", "PushedFilters: [")


def _dataset(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="run-") + "/logs"
    event_logs(spark, SF).write.parquet(path)
    return path


def test_checked_columns_are_lazy(spark):
    """A table that reads no topic does not read the topics' values into its rows."""
    checked = check_logs(logs_of(spark, [GOLDEN[0][0]]))
    assert {"def_id", "log_error"} <= set(checked.columns)
    assert len(DEFAULT.definitions) > checked.select(F.max("def_id")).first()[0] >= 0


def test_repeated_names_keep_the_last_field(spark, ansi):
    """In topics and data, in the topics alone, and under a table's own keys; a shadowed word is still checked."""
    contract, topic0 = "0x" + "33" * 20, "0x" + "02" * 32
    twice = define("p", "v1", "Deposit", "D(address,address,uint16,address,uint256)", topic0, "reserve address, user address, user address", "reserve address, amount uint256, amount uint8")
    registry = Registry((((contract, (twice,)),), *DEFAULT.protocols))
    word = [f"{i:064x}" for i in range(1, 9)]
    logs = logs_of(spark, [(contract, [topic0, *("0x" + w for w in word[:3])], "0x" + "".join(word[3:6])), (contract, [topic0], "0x" + "".join(word[3:6])), (contract, [topic0], "0x" + "f" * 64 + word[4] + word[5])])
    rows = decode_logs(logs, registry).orderBy("block_number").collect()
    expected = {"_event": "Deposit", "_version": "v1", "_contract": contract, "_protocol": "p", "reserve": "0x" + word[3][-40:], "user": "0x" + word[2][-40:], "amount": "6"}
    assert [r["decode_result"]["data"] for r in rows] == [expected, expected | {"user": None}, None]
    assert rows[2]["decode_result"]["error"] == NOT_DECODED
    typed = table_rows(with_target(logs, registry), TABLES[3], registry)
    shaped = shape(decoded_logs(decode_logs(logs, registry)), TABLES[3])
    assert TABLES[3].name == "deposit" and sorted(map(str, typed.collect())) == sorted(map(str, shaped.collect())) and typed.count() == 2


def test_names_of_the_payload_are_refused():
    with pytest.raises(ValueError, match="_event"):
        define("p", "v1", "E", "E(uint256)", "0x" + "01" * 32, "", "_event uint256")
