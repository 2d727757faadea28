"""The expected rows of every query, straight from the source tables by formula.

Nothing here decodes hex or reads the library's shaping rules: which word feeds which column is
stated again, by hand, in ``SHAPED``.
"""

from __future__ import annotations

from logloom.registry import DEFAULT, aave, compound, morpho

from .logs import BORROW_V2, CDAI, MINT, MORPHO, MORPHO_SUPPLY, POOL_V2, UNKNOWN_CONTRACT, WITHDRAW_V2, _formula

GENERIC = "No matching ABI or decode_log returned None"
BAD_TOPIC = "invalid topic word at position 3"
MAX_UINT = str(2**256 - 1)

# Per family of contracts, the definitions that can be reached; three Comet definitions share one
# hash, of which the repayment is the one reached.
FAMILIES = [
    (["0x398ec7346dcd622edc5ae82352f02be94c62d119", "0x2f60c3eb259d63dcca81fde7eaa216d9983d7c60"],
     [aave.DEPOSIT_V1, aave.WITHDRAW_V1, aave.BORROW_V1, aave.REPAY_V1, aave.LIQUIDATION_V1]),
    (["0x633c23fc727e8afd3546d0cf86c8644f0fff16a6"],
     [aave.DEPOSIT_V1, aave.WITHDRAW_V1, aave.BORROW_V1, aave.REPAY_V1]),
    (["0x5f93ad786a1330d2ec97926f073259f70375d146"], [aave.DEPOSIT_V1]),
    ([POOL_V2], [aave.DEPOSIT_V2, aave.WITHDRAW_V2, aave.BORROW_V2, aave.REPAY_V2, aave.LIQUIDATION_V2]),
    (["0x87870bca3f3fd6335c3f4ce8392d69350b4fa4e2"],
     [aave.DEPOSIT_V3, aave.WITHDRAW_V3, aave.BORROW_V3, aave.REPAY_V3, aave.LIQUIDATION_V3]),
    ([c for c, _ in compound.CONTRACTS[:2]], [compound.BORROW_V1, compound.REPAY_V1, compound.LIQUIDATION_V1]),
    ([c for c, _ in compound.CONTRACTS[2:13]],
     [compound.BORROW_V2, compound.REPAY_V2, compound.LIQUIDATION_V2, compound.DEPOSIT_V2, compound.WITHDRAW_V2]),
    ([c for c, _ in compound.CONTRACTS[13:]],
     [compound.WITHDRAW_V3, compound.BORROW_V3_B, compound.REPAY_V3, compound.ABSORB_COLLATERAL_V3,
      compound.ABSORB_DEBT_V3]),
    ([MORPHO], [morpho.DEPOSIT_V1, morpho.WITHDRAW_V1, morpho.BORROW_V1, morpho.REPAY_V1, morpho.LIQUIDATION_V1]),
]

# table: columns; then per definition: column=<value kind><word number>. Topic p is word p, data word i
# is word 10 + i. A address, U decimal, M rate mode, R uint16, T timestamp, B boolean.
SHAPED = {
    "deposit": (
        "reserve:A user:A on_behalf_of:A amount:U mint_tokens:U referral:R referral_code:R chain_timestamp:T",
        """
        aave v1 Deposit: reserve=A1 user=A2 amount=U10 chain_timestamp=T11
        aave v2 Deposit: reserve=A1 on_behalf_of=A2 referral=R3 user=A10 amount=U11
        aave v3 Deposit: reserve=A1 on_behalf_of=A2 referral_code=R3 user=A10 amount=U11
        compound v2 Mint: user=A10 amount=U11 mint_tokens=U12
        morpho v1 Supply: amount=U10
        """,
    ),
    "withdraw": (
        "reserve:A user:A to:A amount:U redeem_tokens:U chain_timestamp:T",
        """
        aave v1 Withdraw: reserve=A1 user=A2 to=A2 amount=U10 chain_timestamp=T11
        aave v2 Withdraw: reserve=A1 user=A2 to=A3 amount=U10
        aave v3 Withdraw: reserve=A1 user=A2 to=A3 amount=U10
        compound v2 Redeem: user=A10 to=A10 amount=U11 redeem_tokens=U12
        compound v3 Withdraw: user=A1 to=A2 amount=U10
        morpho v1 Withdraw: user=A10 amount=U11
        """,
    ),
    "borrow": (
        "reserve:A user:A on_behalf_of:A amount:U borrow_rate_mode:M interest_rate_mode:M borrow_rate:U "
        "origination_fee:U borrow_balance_increase:U starting_balance:U borrow_amount_with_fee:U new_balance:U "
        "account_borrows:U total_borrows:U referral_code:R chain_timestamp:T",
        """
        aave v1 Borrow: reserve=A1 user=A2 referral_code=R3 amount=U10 borrow_rate_mode=M11 borrow_rate=U12 origination_fee=U13 borrow_balance_increase=U14 chain_timestamp=T15
        aave v2 Borrow: reserve=A1 on_behalf_of=A2 referral_code=R3 user=A10 amount=U11 borrow_rate_mode=M12 borrow_rate=U13
        aave v3 Borrow: reserve=A1 on_behalf_of=A2 referral_code=R3 user=A10 amount=U11 interest_rate_mode=M12 borrow_rate=U13
        compound v1 Borrow: user=A10 reserve=A11 amount=U12 starting_balance=U13 borrow_amount_with_fee=U14 new_balance=U15
        compound v2 Borrow: user=A10 amount=U11 account_borrows=U12 total_borrows=U13
        compound v3 Borrow: user=A1 on_behalf_of=A2 amount=U10
        morpho v1 Borrow: on_behalf_of=A3
        """,
    ),
    "repay": (
        "reserve:A user:A repayer:A amount:U amount_minus_fees:U fees:U borrow_balance_increase:U starting_balance:U "
        "new_balance:U account_borrows:U total_borrows:U use_a_tokens:B chain_timestamp:T",
        """
        aave v1 Repay: reserve=A1 user=A2 repayer=A3 amount_minus_fees=U10 fees=U11 borrow_balance_increase=U12 chain_timestamp=T13
        aave v2 Repay: reserve=A1 user=A2 repayer=A3 amount=U10
        aave v3 Repay: reserve=A1 user=A2 repayer=A3 amount=U10 use_a_tokens=B11
        compound v1 RepayBorrow: user=A10 reserve=A11 amount=U12 starting_balance=U13 new_balance=U14
        compound v2 RepayBorrow: repayer=A10 user=A11 amount=U12 account_borrows=U13 total_borrows=U14
        compound v3 Repay: repayer=A1 user=A2 amount=U10
        morpho v1 Repay:
        """,
    ),
    "liquidationcall": (
        "collateral_asset:A debt_asset:A user:A debt_to_cover:U liquidated_collateral_amount:U accrued_borrow_interest:U "
        "liquidator:A receive_a_token:B borrow_balance_before:U borrow_balance_accumulated:U borrow_balance_after:U "
        "collateral_balance_before:U collateral_balance_accumulated:U collateral_balance_after:U usd_value:U "
        "chain_timestamp:T",
        """
        aave v1 LiquidationCall: collateral_asset=A1 debt_asset=A2 user=A3 debt_to_cover=U10 liquidated_collateral_amount=U11 accrued_borrow_interest=U12 liquidator=A13 receive_a_token=B14 chain_timestamp=T15
        aave v2 LiquidationCall: collateral_asset=A1 debt_asset=A2 user=A3 debt_to_cover=U10 liquidated_collateral_amount=U11 liquidator=A12 receive_a_token=B13
        aave v3 LiquidationCall: collateral_asset=A1 debt_asset=A2 user=A3 debt_to_cover=U10 liquidated_collateral_amount=U11 liquidator=A12 receive_a_token=B13
        compound v1 LiquidateBorrow: user=A10 debt_asset=A11 borrow_balance_before=U12 borrow_balance_accumulated=U13 debt_to_cover=U14 borrow_balance_after=U15 liquidator=A16 collateral_asset=A17 collateral_balance_before=U18 collateral_balance_accumulated=U19 liquidated_collateral_amount=U20 collateral_balance_after=U21
        compound v2 LiquidateBorrow: liquidator=A10 user=A11 debt_to_cover=U12 collateral_asset=A13 liquidated_collateral_amount=U14
        compound v3 AbsorbCollateral: liquidator=A1 user=A2 collateral_asset=A3 liquidated_collateral_amount=U10 usd_value=U11
        compound v3 AbsorbDebt: liquidator=A1 user=A2 debt_to_cover=U10 usd_value=U11
        """,
    ),
}
COLUMN_TYPES = {"A": "VARCHAR", "U": "VARCHAR", "M": "INTEGER", "R": "INTEGER", "T": "BIGINT", "B": "BOOLEAN"}


def _rows(values: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in values)


def _wide(j: str) -> str:
    return (
        f"(CAST((k * 7 + {j}) % 1000003 AS HUGEINT) * 18446744073709551616 "
        f"+ (k * 2654435761 + {j} * 97) % 4294967291)"
    )


def _hex(value: str, digits: int) -> str:
    return f"'0x' || lpad(lower(to_hex({value})), {digits}, '0')"


def _value(code: str) -> str:
    kind, j = code[0], code[1:]
    return {
        "A": _hex(f"k * 31 + {j}", 40),
        "U": f"CAST({_wide(j)} AS DECIMAL(38,0))",
        "M": "CAST(1 + k % 2 AS INTEGER)",
        "R": f"CAST((k + {j}) % 65536 AS INTEGER)",
        "T": "1577836800 + k",
        "B": f"(k + {j}) % 2 = 1",
    }[kind]


def base(k: str = "event_id", ts: str = "ts", table: str = "events") -> str:
    """``l``: one row per log with its route, whether it passes the filter, and whether it decodes."""
    routes = [(c, d.topic0, d.protocol, d.version, d.event) for contracts, defs in FAMILIES for c in contracts for d in defs]

    def route(contract: str, topic0: str) -> str:
        return f"(SELECT r FROM routes WHERE contract = '{contract}' AND topic0 = '{topic0}')"

    return f"""
    WITH listed(contract, topic0, protocol, version, event) AS (VALUES {_rows(routes)}),
    routes AS (SELECT *, row_number() OVER (ORDER BY contract, topic0) - 1 AS r FROM listed),
    e AS (SELECT {k} AS k, {ts} AS ts, ({k}) % 20 AS kind,
                 CASE WHEN ({k}) % 20 = 19 THEN (({k}) // 20) % 14 ELSE -1 END AS sp FROM {table}),
    p AS (SELECT *, CASE WHEN sp = 11 THEN {route(POOL_V2, WITHDRAW_V2)} WHEN sp = 13 THEN {route(POOL_V2, BORROW_V2)}
                         WHEN sp >= 0 THEN {route(CDAI, MINT)} ELSE k % {len(routes)} END AS pick FROM e),
    l AS (SELECT p.*, routes.*, CAST(ts AS DATE) AS date, 18000000 + k AS block_number, k % 500 AS log_index,
                 {_hex("k", 64)} AS transaction_hash, kind <> 17 AND sp NOT IN (5, 6, 7) AS known,
                 kind < 17 OR sp IN (8, 9, 10, 11) AS ok
          FROM p JOIN routes ON r = pick)"""


def _targets() -> str:
    rows = [(*line.split(":")[0].split(), table) for table, (_, text) in SHAPED.items() for line in _lines(text)]
    return f"targets(protocol, version, event, \"table\") AS (VALUES {_rows(rows)})"


def _lines(text: str) -> list[str]:
    return [line.strip() for line in text.splitlines() if line.strip()]


def shaped(table: str) -> str:
    columns, text = SHAPED[table]
    cases: dict[str, list[str]] = {}
    keys = []
    for line in _lines(text):
        head, values = line.split(":")
        protocol, version, event = head.split()
        match = f"protocol = '{protocol}' AND version = '{version}' AND event = '{event}'"
        keys.append(f"({match})")
        for item in values.split():
            column, code = item.split("=")
            cases.setdefault(column, []).append(f"WHEN {match} THEN {_value(code)}")
    selected = []
    for item in columns.split():
        column, kind = item.split(":")
        first = {("deposit", "amount"): "WHEN sp = 10 THEN NULL", ("withdraw", "to"): f"WHEN sp = 11 THEN {_value('A2')}"}
        whens = " ".join([first.get((table, column), "")] + cases.get(column, []))
        value = f"CASE {whens} END" if column in cases else "NULL"
        selected.append(f'CAST({value} AS {COLUMN_TYPES[kind]}) AS "{column}"')
    return f"""{base()} SELECT block_number, ts AS block_timestamp, transaction_hash, CAST(log_index AS INTEGER) AS log_index,
        protocol, version AS protocol_version, date, contract AS project_contract, {', '.join(selected)}
        FROM l WHERE ok AND ({' OR '.join(keys)})"""


def all_shaped() -> str:
    """The five tables as rows (table, transaction_hash, column, value), the values as text."""
    parts, selected = [], []
    for table, (columns, _) in SHAPED.items():
        parts.append(f'"{table}" AS MATERIALIZED ({shaped(table)})')
        header = ["block_number", "log_index", "protocol", "protocol_version", "date", "project_contract"]
        for column in [*header, *(item.split(":")[0] for item in columns.split())]:
            selected.append(f"""SELECT '{table}' AS "table", transaction_hash, '{column}' AS "column", CAST("{column}" AS VARCHAR) AS value FROM "{table}\"""")
        selected.append(f"""SELECT '{table}', transaction_hash, 'block_timestamp', CAST(epoch_us(block_timestamp) AS VARCHAR) FROM "{table}\"""")
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(selected)}"


def mint_counts() -> str:
    """Rows per written table and date of the logs whose first topic is that of the cToken mint."""
    return event_counts(by_date=True, written=True, where=f"((kind <> 18 AND topic0 = '{MINT}') OR (kind = 18 AND contract = '{MORPHO}'))")


def repeated_names() -> str:
    """Deposits of one pool by a definition that uses ``reserve`` twice: the data's value stays."""
    fields = {"_event": "event", "_version": "version", "_contract": "contract", "_protocol": "protocol", "reserve": _field_text("address", "10"),
              "onBehalfOf": _field_text("address", "2"), "referral": _field_text("uint16", "3"), "amount": _field_text("wide", "11")}
    return base() + " UNION ALL ".join(
        f" SELECT block_number, '{name}' AS name, {value} AS value FROM l WHERE ok AND contract = '{POOL_V2}' AND event = 'Deposit'" for name, value in fields.items()
    )


def logs_date_range(first: str, last: str) -> str:
    return f"""{base()} SELECT date, count(*) AS n, min(block_number) AS first_block, max(block_number) AS last_block
        FROM l WHERE date BETWEEN DATE '{first}' AND DATE '{last}' GROUP BY date"""


def logs_known() -> str:
    """All columns of the filter's result, the topics as one text."""
    topics = f"concat_ws(',', first_topic, CASE WHEN sp = 11 THEN {_topics_of(WITHDRAW_V2, 2)} ELSE {_per_definition(_topics)} END)"
    return f"""{_raw('known')} SELECT block_number, ts AS block_timestamp, transaction_hash, CAST(log_index AS BIGINT) AS log_index, date,
        CASE WHEN sp = 8 THEN '0x{CDAI[2:].upper()}' ELSE contract END AS address, {topics} AS topics, {_faulty_data()} AS data FROM d"""


def decode_status() -> str:
    return f"""{base()} SELECT ok AS success,
        CASE WHEN ok THEN NULL WHEN sp = 13 THEN '{BAD_TOPIC}' ELSE '{GENERIC}' END AS error, count(*) AS n
        FROM l WHERE known GROUP BY 1, 2"""


def _word(formula: str, j: int) -> str:
    """64 hex digits of word j."""
    narrow = {
        "address": f"k * 31 + {j}",
        "bytes32": f"k * 17 + {j}",
        "uint16": f"(k + {j}) % 65536",
        "mode": "k % 2 + 1",
        "timestamp": "1577836800 + k",
        "bool": f"(k + {j}) % 2",
    }
    if formula in narrow:
        return f"lpad(lower(to_hex({narrow[formula]})), 64, '0')"
    high, low = f"(k * 7 + {j}) % 1000003", f"(k * 2654435761 + {j} * 97) % 4294967291"
    return f"lpad(lower(to_hex({high})), 48, '0') || lpad(lower(to_hex({low})), 16, '0')"


def _per_definition(text) -> str:
    """A CASE over the reachable definitions; ``text`` gives the expression of one."""
    defs = dict.fromkeys(d for _, reached in FAMILIES for d in reached)
    whens = [f"WHEN protocol = '{d.protocol}' AND version = '{d.version}' AND event = '{d.event}' THEN {text(d)}" for d in defs]
    return f"CASE {' '.join(whens)} END"


def _topics(d, most: int = 3) -> str:
    """The topics after the first one, comma-separated."""
    words = [f"'0x' || {_word(_formula(*field), j)}" for j, field in enumerate(d.topic_fields[:most], 1)]
    if (d.protocol, d.version, d.event) == ("aave", "v2", "Borrow"):
        words[2] = f"CASE WHEN sp = 13 THEN '0xzz' ELSE {words[2]} END"
    return " || ',' || ".join(words) or "NULL"


def _topics_of(topic0: str, most: int) -> str:
    return _topics(next(d for _, reached in FAMILIES for d in reached if d.topic0 == topic0), most)


def _payload(d) -> str:
    return " || ".join(["'0x'"] + [_word(_formula(*field), j) for j, field in enumerate(d.data_fields, 10)])


def _raw(condition: str) -> str:
    """``d``: logs with their first topic and the payload without faults."""
    foreign = f"CASE WHEN contract = '{MORPHO}' THEN '{MINT}' ELSE '{MORPHO_SUPPLY}' END"
    return f"""{base()},
        t AS (SELECT *, CASE WHEN kind = 18 THEN {foreign} ELSE topic0 END AS first_topic FROM l WHERE {condition}),
        d AS (SELECT *, {_per_definition(_payload)} AS body FROM t)"""


def _faulty_data() -> str:
    return f"""CASE sp WHEN 0 THEN left(body, length(body) - 64) WHEN 1 THEN left(body, length(body) - 1)
        WHEN 2 THEN '0xzz' || substr(body, 5) WHEN 3 THEN NULL WHEN 4 THEN '' WHEN 9 THEN body || '{"f" * 64}'
        WHEN 10 THEN left(body, 66) || '{"f" * 64}' || substr(body, 131) WHEN 12 THEN '0xff' || substr(body, 5) ELSE body END"""


def dead_letter() -> str:
    """Every word of topics and payload by its formula, then the faults of the special logs."""
    return f"""{_raw('known AND NOT ok')} SELECT block_number, ts AS block_timestamp, transaction_hash, CAST(log_index AS BIGINT) AS log_index, date,
        contract AS address, CASE WHEN sp = 13 THEN '{BAD_TOPIC}' ELSE '{GENERIC}' END AS error,
        concat_ws(',', first_topic, {_per_definition(_topics)}) AS topics, {_faulty_data()} AS raw_data FROM d"""


def _field_text(formula: str, j: str) -> str:
    return {
        "address": _hex(f"k * 31 + {j}", 40),
        "bytes32": _hex(f"k * 17 + {j}", 64),
        "uint16": f"CAST((k + {j}) % 65536 AS VARCHAR)",
        "mode": "CAST(1 + k % 2 AS VARCHAR)",
        "timestamp": "CAST(1577836800 + k AS VARCHAR)",
        "bool": f"CASE WHEN (k + {j}) % 2 = 1 THEN 'True' ELSE 'False' END",
        "wide": f"CAST({_wide(j)} AS VARCHAR)",
    }[formula]


def decode_fields() -> str:
    defs = {d for _, reached in FAMILIES for d in reached}
    fields = [
        (d.protocol, d.version, d.event, name, _formula(name, kind), j)
        for d in DEFAULT.definitions
        if d in defs
        for j, (name, kind) in [*enumerate(d.topic_fields, 1), *enumerate(d.data_fields, 10)]
    ]
    formulas = sorted({f[4] for f in fields})
    value = " ".join(f"WHEN formula = '{f}' THEN {_field_text(f, 'j')}" for f in formulas)
    meta = " UNION ALL ".join(
        f"SELECT block_number, '{name}' AS name, {column} AS value FROM l WHERE ok"
        for name, column in [("_event", "event"), ("_version", "version"), ("_contract", "contract"), ("_protocol", "protocol")]
    )
    return f"""{base()}, fields(protocol, version, event, name, formula, j) AS (VALUES {_rows(fields)})
        {meta} UNION ALL
        SELECT block_number, name, CASE WHEN sp = 10 AND name = 'mint_amount' THEN '{MAX_UINT}'
            WHEN sp = 11 AND name = 'to' THEN NULL {value} END AS value
        FROM l JOIN fields USING (protocol, version, event) WHERE ok"""


def event_counts(by_date: bool = False, written: bool = False, where: str = "true") -> str:
    date = "date, " if by_date else ""
    unshaped = " AND (NOT ok OR \"table\" IS NOT NULL)" if written else ""
    return f"""{base()}, {_targets()}
        SELECT {date}CASE WHEN ok THEN coalesce("table", 'unshaped') ELSE 'dead_letter' END AS "table", count(*) AS n
        FROM l LEFT JOIN targets USING (protocol, version, event) WHERE known{unshaped} AND {where} GROUP BY ALL"""


def route_usage() -> str:
    return f"""{base()} SELECT routes.contract, routes.event, routes.version, routes.topic0, routes.protocol,
        count(l.k) AS n_logs, min(l.block_number) AS first_block
        FROM routes LEFT JOIN l ON l.contract = routes.contract AND l.topic0 = routes.topic0 AND l.known AND l.kind <> 18
        GROUP BY ALL"""


def contract_usage() -> str:
    foreign = f"CASE WHEN contract = '{MORPHO}' THEN '{MINT}' ELSE '{MORPHO_SUPPLY}' END"
    return f"""{base()}, s AS (SELECT CASE WHEN kind = 17 THEN '{UNKNOWN_CONTRACT}' ELSE contract END AS contract, k,
            CASE WHEN sp IN (5, 6) THEN NULL WHEN sp = 7 THEN '0x{MINT[2:].upper()}' WHEN kind = 18 THEN {foreign}
            ELSE topic0 END AS topic0 FROM l)
        SELECT contract, contract <> '{UNKNOWN_CONTRACT}' AS known_contract, count(*) AS n_logs,
        count(DISTINCT topic0) AS n_topic0s,
        count(CASE WHEN topic0 IN (SELECT topic0 FROM routes) THEN 1 END) AS n_known_topic0 FROM s GROUP BY contract"""


def deposit_totals() -> str:
    amounts = " ".join(
        f"WHEN protocol = '{p}' AND version = '{v}' AND event = '{e}' THEN {_value(code)}"
        for p, v, e, code in [
            ("aave", "v1", "Deposit", "U10"), ("aave", "v2", "Deposit", "U11"), ("aave", "v3", "Deposit", "U11"),
            ("compound", "v2", "Mint", "U11"), ("morpho", "v1", "Supply", "U10"),
        ]
    )
    return f"""{base("l_orderkey * 7 + l_linenumber", "l_shipdate", "lineitem")}
        SELECT date, contract AS project_contract, count(*) AS n_deposits,
        CAST(sum(CASE WHEN sp = 10 THEN NULL {amounts} END) AS VARCHAR) AS total_amount
        FROM l WHERE ok AND event IN ('Deposit', 'Mint', 'Supply') GROUP BY date, contract"""


def _times_2_256(factor: str) -> str:
    """factor * 2^256 in base 10, by limbs of 18 digits; the factor must stay below 10^18."""
    limb, carry, texts = 10**18, "0", []
    for i in range(5):
        product = f"(CAST({factor} AS HUGEINT) * {2**256 // limb**i % limb} + {carry})"
        texts.append(f"lpad(CAST({product} % {limb} AS VARCHAR), 18, '0')" if i < 4 else f"CAST({product} AS VARCHAR)")
        carry = f"{product} // {limb}"
    return " || ".join(reversed(texts))


def word_values() -> str:
    return f"""SELECT event_id AS k, {_hex("event_id * 31 + 7", 40)} AS as_address,
        CASE WHEN event_id % 3 = 0 THEN 'False' ELSE 'True' END AS as_bool,
        CAST(CAST(event_id % 1000003 AS HUGEINT) * 18446744073709551616 + event_id * 97 AS VARCHAR) AS as_uint256,
        CAST(-1 - event_id AS VARCHAR) AS as_int256, CAST(event_id % 256 - CASE WHEN event_id % 256 >= 128 THEN 256 ELSE 0 END
        AS VARCHAR) AS as_int8, '0x' || lpad(lower(to_hex(event_id)), 8, '0') AS as_bytes4,
        {_times_2_256("(event_id + 1)")} AS as_long, {_hex("event_id", 64)} AS as_other FROM events"""


def data_checks() -> str:
    return """WITH c AS (SELECT event_id AS k, event_id % 7 AS shape FROM events)
        SELECT shape, CASE WHEN shape IN (2, 5) THEN NULL ELSE CASE WHEN shape = 0 THEN 0 ELSE 32 END END AS n_bytes,
        shape IN (1, 6) AS is_address, shape = 6 AS is_uint8, shape = 6 AS is_bool,
        count(*) AS n FROM c GROUP BY ALL"""
