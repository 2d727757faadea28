"""The five unified event tables, from decoded payloads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


DEAD_LETTER = "dead_letter"
UNSHAPED = "unshaped"


@dataclass(frozen=True)
class ShapedColumn:
    name: str
    sql_type: str
    keys: tuple[str, ...]  # payload keys, the first present one wins


@dataclass(frozen=True)
class EventTable:
    name: str
    labels: tuple[str, ...]
    columns: tuple[ShapedColumn, ...]


def event_table(name: str, labels: str, columns: str) -> EventTable:
    """One line per column: ``name type: key key ...``."""
    parsed = []
    for line in filter(None, map(str.strip, columns.splitlines())):
        head, keys = line.split(":")
        column, sql_type = head.split()
        parsed.append(ShapedColumn(column, _TYPES.get(sql_type, sql_type), tuple(keys.split())))
    return EventTable(name, tuple(labels.split()), tuple(parsed))


_TYPES = {"amount": "decimal(38,0)"}

# Table names, event labels, output columns and the payload keys they are taken from.
DEPOSIT = event_table(
    "deposit",
    "Deposit Mint Supply",
    """
    reserve string: reserve
    user string: user minter from sender
    on_behalf_of string: onBehalfOf dst receiver
    amount amount: amount mint_amount assets
    mint_tokens amount: mint_tokens
    referral int: referral
    referral_code int: referralCode
    chain_timestamp bigint: timestamp
    """,
)
WITHDRAW = event_table(
    "withdraw",
    "Withdraw Redeem",
    """
    reserve string: reserve
    user string: user redeemer src caller
    to string: to user redeemer src reciever
    amount amount: amount redeem_amount assets
    redeem_tokens amount: redeem_tokens
    chain_timestamp bigint: timestamp
    """,
)
BORROW = event_table(
    "borrow",
    "Borrow",
    """
    reserve string: reserve asset
    user string: user borrower account sender
    on_behalf_of string: on_behalf_of onBehalfOf receiver
    amount amount: amount borrow_amount eth
    borrow_rate_mode int: borrow_rate_mode
    interest_rate_mode int: interest_rate_mode
    borrow_rate amount: borrow_rate
    origination_fee amount: origination_fee
    borrow_balance_increase amount: borrow_balance_increase
    starting_balance amount: startingBalance
    borrow_amount_with_fee amount: borrowAmountWithFee
    new_balance amount: newBalance
    account_borrows amount: account_borrows
    total_borrows amount: total_borrows
    referral_code int: referral
    chain_timestamp bigint: timestamp
    """,
)
REPAY = event_table(
    "repay",
    "Repay RepayBorrow",
    """
    reserve string: reserve asset
    user string: user borrower account dst
    repayer string: repayer payer from
    amount amount: amount repay_amount
    amount_minus_fees amount: amount_minus_fees
    fees amount: fees
    borrow_balance_increase amount: borrow_balance_increase
    starting_balance amount: startingBalance
    new_balance amount: newBalance
    account_borrows amount: account_borrows
    total_borrows amount: total_borrows
    use_a_tokens boolean: use_a_tokens
    chain_timestamp bigint: timestamp
    """,
)
LIQUIDATION = event_table(
    "liquidationcall",
    "LiquidationCall LiquidateBorrow AbsorbCollateral AbsorbDebt",
    """
    collateral_asset string: collateral_asset collateral assetCollateral c_token_collateral asset
    debt_asset string: debt_asset reserve asset_borrow
    user string: user target_account borrower
    debt_to_cover amount: debt_to_cover purchase_amount amountRepaid repay_amount base_paid_out
    liquidated_collateral_amount amount: liquidated_collateral_amount amountSeized seize_tokens collateral_absorbed
    accrued_borrow_interest amount: accrued_borrow_interest
    liquidator string: liquidator absorber
    receive_a_token boolean: receive_a_token
    borrow_balance_before amount: borrowBalanceBefore
    borrow_balance_accumulated amount: borrowBalanceAccumulated
    borrow_balance_after amount: borrowBalanceAfter
    collateral_balance_before amount: collateralBalanceBefore
    collateral_balance_accumulated amount: collateralBalanceAccumulated
    collateral_balance_after amount: collateralBalanceAfter
    usd_value amount: usd_value
    chain_timestamp bigint: timestamp
    """,
)

# in the order the tables are written
TABLES = (BORROW, REPAY, LIQUIDATION, DEPOSIT, WITHDRAW)
DEFAULT_PROTOCOL = "aave"


def header(protocol: Column, version: Column, contract: Column) -> list[Column]:
    """The eight leading columns of every table."""
    return [
        F.col("block_number").try_cast("bigint").alias("block_number"),
        F.col("block_timestamp").try_cast("timestamp").alias("block_timestamp"),
        F.col("transaction_hash"),
        F.col("log_index").try_cast("int").alias("log_index"),
        F.coalesce(protocol, F.lit(DEFAULT_PROTOCOL)).alias("protocol"),
        version.alias("protocol_version"),
        F.col("date"),
        contract.alias("project_contract"),
    ]


def event_label(decoded: DataFrame, payload: Column) -> Column:
    """The event label of decoded logs. Taken from the column that ``decode_logs`` left: a filter on it is
    pushed below the decoding, while one on the payload would build the map to look at it."""
    return F.col("event") if "event" in decoded.columns else payload["_event"]


def shape(decoded: DataFrame, table: EventTable) -> DataFrame:
    """One event table from logs that carry a ``decoded`` payload map."""
    payload = F.col("decoded")

    def column(spec: ShapedColumn) -> Column:
        value = F.coalesce(*[payload[key] for key in spec.keys])
        return (value if spec.sql_type == "string" else value.try_cast(spec.sql_type)).alias(spec.name)

    return decoded.where(event_label(decoded, payload).isin(*table.labels)).select(
        *header(payload["_protocol"], payload["_version"], payload["_contract"]),
        *[column(spec) for spec in table.columns],
    )


def shape_deposit(decoded: DataFrame) -> DataFrame:
    return shape(decoded, DEPOSIT)


def shape_withdraw(decoded: DataFrame) -> DataFrame:
    return shape(decoded, WITHDRAW)


def shape_borrow(decoded: DataFrame) -> DataFrame:
    return shape(decoded, BORROW)


def shape_repay(decoded: DataFrame) -> DataFrame:
    return shape(decoded, REPAY)


def shape_liquidation(decoded: DataFrame) -> DataFrame:
    return shape(decoded, LIQUIDATION)


def table_of_label(label: str, tables: tuple[EventTable, ...] = TABLES) -> str:
    """The table an event label belongs to; ``unshaped`` when none takes it."""
    owners = [t.name for t in tables if label in t.labels]
    if len(owners) > 1:
        raise ValueError(f"label {label!r} is claimed by {owners}")
    return owners[0] if owners else UNSHAPED
