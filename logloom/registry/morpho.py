"""Morpho V1."""

from .model import define

# Event signatures, their Keccak-256 hashes, field names and contract addresses.
BORROW_V1 = define(
    "morpho", "v1", "Borrow",
    "Borrow(bytes32,address,address,address,uint256,uint256)",
    "0x570954540bed6b1304a87dfe815a5eda4a648f7097a16240dcd85c9b5fd42a43",
    "id bytes32, onBehalf address, receiver address",
    "caller address, assets uint256, shares uint256",
)
REPAY_V1 = define(
    "morpho", "v1", "Repay",
    "Repay(bytes32,address,address,uint256)",
    "0x1e7e270b7aed8bc0f6449429f62fa2f169ffef2b6d2f50a808f11169295f4289",
    "id bytes32, caller address, onBehalf address",
    "shares uint256",
)
LIQUIDATION_V1 = define(
    "morpho", "v1", "Liquidate",
    "Liquidate(bytes32,address,address,uint256,uint256,uint256,uint256,uint256)",
    "0xa4946ede45d0c6f06a0f5ce92c9ad3b4751452d2fe0e25010783bcab57a67e41",
    "id bytes32, caller address, borrower address",
    "repaidAssets uint256, repaidShares uint256, seizedAssets uint256, badDebtAssets uint256, badDebtShares uint256",
)
DEPOSIT_V1 = define(
    "morpho", "v1", "Supply",
    "Supply(bytes32,address,address,uint256,uint256)",
    "0xedf8870433c83823eb071d3df1caa8d008f12f6440918c20d75a3602cda30fe0",
    "id bytes32, caller address, onBehalf address",
    "assets uint256, shares uint256",
)
WITHDRAW_V1 = define(
    "morpho", "v1", "Withdraw",
    "Withdraw(bytes32,address,address,uint256,uint256)",
    "0x77c1bdea1f3bd10268d0ccee81dfee3623cd56914081a41b0a3bf72d9fa9c5f0",
    "id bytes32, onBehalf address, receiver address",
    "caller address, assets uint256, shares uint256",
)

CONTRACTS = (
    ("0xbbbbbbbbbb9cc5e90e3b3af64bdaf62c37eeffcb", (DEPOSIT_V1, WITHDRAW_V1, BORROW_V1, REPAY_V1, LIQUIDATION_V1)),
)
