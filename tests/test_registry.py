from pyspark.sql import functions as F

from logloom import registry as reg
from logloom.operators.decode import route_logs
from logloom.registry import DEFAULT, Registry, compound, define
from logloom.registry import model
from workload.logs import event_logs


def test_sizes(spark):
    assert len(DEFAULT.definitions) == 35
    assert len(DEFAULT.topic0s) == 31
    assert len(DEFAULT.contracts) == 23
    assert reg.routes(spark, DEFAULT).count() == 106
    assert reg.event_definitions(spark, DEFAULT).count() == 35


def test_hashes_and_addresses_are_well_formed():
    assert all(len(t) == 66 and t.startswith("0x") and int(t, 16) for t in DEFAULT.topic0s)
    assert all(len(c) == 42 and c == c.lower() for c in DEFAULT.contracts)


def test_last_definition_wins(spark):
    comet = [c for c, defs in compound.CONTRACTS if defs is compound.COMET_V3]
    rows = (
        reg.route_listing(spark, DEFAULT)
        .where(F.col("contract").isin(comet) & (F.col("topic0") == compound.SUPPLY_V3.topic0))
        .collect()
    )
    assert [r["event"] for r in rows] == ["Repay"] * 3


def test_later_protocol_wins(spark):
    contract = "0x" + "AB" * 20
    first = define("one", "v1", "First", "E(uint256)", "0x" + "01" * 32, "", "x uint256")
    second = define("two", "v1", "Second", "E(uint256)", "0x" + "01" * 32, "", "y uint256")
    registry = Registry((((contract, (first, first)),), ((contract, (second,)),)))
    rows = reg.route_listing(spark, registry).collect()
    assert [(r["contract"], r["event"]) for r in rows] == [(contract.lower(), "Second")]


def test_listing_is_ordered(spark):
    keys = [(r["contract"], r["topic0"]) for r in reg.route_listing(spark, DEFAULT).collect()]
    assert keys == sorted(keys) and len(set(keys)) == 106


def test_signature_arity():
    """Two definitions declare another number of fields than their signature, on purpose."""
    odd = {
        (d.protocol, d.version, d.event)
        for d in DEFAULT.definitions
        if d.signature.count(",") + 1 != len(d.topic_fields) + len(d.data_fields)
    }
    assert odd == {("aave", "v1", "Deposit"), ("morpho", "v1", "Withdraw")}


def test_routes_need_no_exchange(spark):
    plan = reg.routes(spark, DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def keccak256(message: bytes) -> str:
    """The hash that event signatures are listed under, by its published definition; for the test alone."""
    mask = (1 << 64) - 1
    rotate = lambda v, n: ((v << n) | (v >> (64 - n))) & mask if n else v
    constants, lfsr = [], 1
    for _ in range(24):
        constant = 0
        for j in range(7):
            if lfsr & 1:
                constant |= 1 << ((1 << j) - 1)
            lfsr = (lfsr << 1) ^ (0x171 if lfsr & 0x80 else 0)
        constants.append(constant)
    offsets, (x, y) = {(0, 0): 0}, (1, 0)
    for t in range(24):
        offsets[x, y] = (t + 1) * (t + 2) // 2 % 64
        x, y = y, (2 * x + 3 * y) % 5
    padded = message + b"\x01" + b"\0" * (-(len(message) + 1) % 136)
    padded = padded[:-1] + bytes([padded[-1] | 0x80])
    state = {(x, y): 0 for x in range(5) for y in range(5)}
    for block in range(0, len(padded), 136):
        for i in range(17):
            state[i % 5, i // 5] ^= int.from_bytes(padded[block + 8 * i : block + 8 * i + 8], "little")
        for constant in constants:
            columns = [state[x, 0] ^ state[x, 1] ^ state[x, 2] ^ state[x, 3] ^ state[x, 4] for x in range(5)]
            mixed = {(x, y): v ^ columns[(x - 1) % 5] ^ rotate(columns[(x + 1) % 5], 1) for (x, y), v in state.items()}
            moved = {(y, (2 * x + 3 * y) % 5): rotate(v, offsets[x, y]) for (x, y), v in mixed.items()}
            state = {(x, y): moved[x, y] ^ (~moved[(x + 1) % 5, y] & mask & moved[(x + 2) % 5, y]) for x, y in moved}
            state[0, 0] ^= constant
    return "0x" + b"".join(state[i, 0].to_bytes(8, "little") for i in range(4)).hex()


def test_hashes_are_those_of_the_signatures():
    assert keccak256(b"Transfer(address,address,uint256)") == "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
    for d in DEFAULT.definitions:
        assert keccak256(d.signature.encode()) == d.topic0, d


def test_large_registries_are_not_broadcast(spark, monkeypatch):
    logs = event_logs(spark, "/root/testdata/sf0.001")
    expected = route_logs(logs).groupBy("def_id").count().collect()
    monkeypatch.setattr(model, "MAX_BROADCAST_ROWS", 1)
    routed = route_logs(logs)
    assert "BroadcastHashJoin" not in routed._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, routed.groupBy("def_id").count().collect())) == sorted(map(str, expected))
