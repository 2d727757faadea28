"""Compound V1 money market, V2 cTokens, V3 Comet."""

from .model import define

# Event signatures, their Keccak-256 hashes, field names and contract addresses.
BORROW_V1 = define(
    "compound", "v1", "Borrow",
    "BorrowTaken(address,address,uint256,uint256,uint256,uint256)",
    "0x6b69190ebbb96f162b04dc222ef96416f9dca9a415b6dd183c79424501113e18",
    "",
    "account address, asset address, amount uint256, startingBalance uint256, borrowAmountWithFee uint256, "
    "newBalance uint256",
)
BORROW_V2 = define(
    "compound", "v2", "Borrow",
    "Borrow(address,uint256,uint256,uint256)",
    "0x13ed6866d4e1ee6da46f845c46d7e54120883d75c5ea9a2dacc1c4ca8984ab80",
    "",
    "borrower address, borrow_amount uint256, account_borrows uint256, total_borrows uint256",
)
REPAY_V1 = define(
    "compound", "v1", "RepayBorrow",
    "BorrowRepaid(address,address,uint256,uint256,uint256)",
    "0x550e7e464126359c6adc43831f011682856b177df6c49c0af6675dd2a063649d",
    "",
    "account address, asset address, amount uint256, startingBalance uint256, newBalance uint256",
)
REPAY_V2 = define(
    "compound", "v2", "RepayBorrow",
    "RepayBorrow(address,address,uint256,uint256,uint256)",
    "0x1a2a22cb034d26d1854bdc6666a5b91fe25efbbb5dcad3b0355478d6f5c362a1",
    "",
    "payer address, borrower address, repay_amount uint256, account_borrows uint256, total_borrows uint256",
)
LIQUIDATION_V1 = define(
    "compound", "v1", "LiquidateBorrow",
    "BorrowLiquidated(address,address,uint256,uint256,uint256,uint256,address,address,uint256,uint256,uint256,uint256)",
    "0x0938b1e79e1fd5816573487e5bd6a1e1329ec26f94f401a7b49d4b71d479657a",
    "",
    "target_account address, asset_borrow address, borrowBalanceBefore uint256, borrowBalanceAccumulated uint256, "
    "amountRepaid uint256, borrowBalanceAfter uint256, liquidator address, assetCollateral address, "
    "collateralBalanceBefore uint256, collateralBalanceAccumulated uint256, amountSeized uint256, "
    "collateralBalanceAfter uint256",
)
LIQUIDATION_V2 = define(
    "compound", "v2", "LiquidateBorrow",
    "LiquidateBorrow(address,address,uint256,address,uint256)",
    "0x298637f684da70674f26509b10f07ec2fbc77a335ab1e7d6215a4b2484d8bb52",
    "",
    "liquidator address, borrower address, repay_amount uint256, c_token_collateral address, seize_tokens uint256",
)
DEPOSIT_V2 = define(
    "compound", "v2", "Mint",
    "Mint(address,uint256,uint256)",
    "0x4c209b5fc8ad50758f13e2e1088ba56a560dff690a1c6fef26394f4c03821c4f",
    "",
    "minter address, mint_amount uint256, mint_tokens uint256",
)
WITHDRAW_V2 = define(
    "compound", "v2", "Redeem",
    "Redeem(address,uint256,uint256)",
    "0xe5b754fb1abb7f01b499791d0b820ae3b6af3424ac1c59768edb53f4ec31a929",
    "",
    "redeemer address, redeem_amount uint256, redeem_tokens uint256",
)
SUPPLY_V3 = define(
    "compound", "v3", "Supply",
    "Supply(address,address,uint256)",
    "0xd1cf3d156d5f8f0d50f6c122ed609cec09d35c9b9fb3fff6ea0959134dae424e",
    "from address, dst address",
    "amount uint256",
)
SUPPLY_V3_B = define(
    "compound", "v3", "Supply",
    "Supply(address,address,uint256)",
    "0xd1cf3d156d5f8f0d50f6c122ed609cec09d35c9b9fb3fff6ea0959134dae424e",
    "sender address, receiver address",
    "amount uint256",
)
WITHDRAW_V3 = define(
    "compound", "v3", "Withdraw",
    "Withdraw(address,address,uint256)",
    "0x9b1bfa7fa9ee420a16e124f794c35ac9f90472acc99140eb2f6447c714cad8eb",
    "src address, to address",
    "amount uint256",
)
BORROW_V3_B = define(
    "compound", "v3", "Borrow",
    "withdraw(address,address,uint256)",
    "0xd9caed12f81c440f63c9677a4301dff8e874a7abd93e3ecd0aaea4ffa129d9fb",
    "sender address, receiver address",
    "eth uint256",
)
REPAY_V3 = define(
    "compound", "v3", "Repay",
    "Supply(address,address,uint256)",
    "0xd1cf3d156d5f8f0d50f6c122ed609cec09d35c9b9fb3fff6ea0959134dae424e",
    "from address, dst address",
    "amount uint256",
)
ABSORB_COLLATERAL_V3 = define(
    "compound", "v3", "AbsorbCollateral",
    "AbsorbCollateral(address,address,address,uint256,uint256)",
    "0x9850ab1af75177e4a9201c65a2cf7976d5d28e40ef63494b44366f86b2f9412e",
    "absorber address, borrower address, asset address",
    "collateral_absorbed uint256, usd_value uint256",
)
ABSORB_DEBT_V3 = define(
    "compound", "v3", "AbsorbDebt",
    "AbsorbDebt(address,address,uint256,uint256)",
    "0x1547a878dc89ad3c367b6338b4be6a65a5dd74fb77ae044da1e8747ef1f4f62f",
    "absorber address, borrower address",
    "base_paid_out uint256, usd_value uint256",
)

MONEY_MARKET_V1 = (BORROW_V1, REPAY_V1, LIQUIDATION_V1)
CTOKEN_V2 = (BORROW_V2, REPAY_V2, LIQUIDATION_V2, DEPOSIT_V2, WITHDRAW_V2)
# SUPPLY_V3, SUPPLY_V3_B and REPAY_V3 share one hash: REPAY_V3 is last, so it wins.
COMET_V3 = (SUPPLY_V3, WITHDRAW_V3, SUPPLY_V3_B, BORROW_V3_B, REPAY_V3, ABSORB_COLLATERAL_V3, ABSORB_DEBT_V3)

CONTRACTS = (
    ("0x3fda67f7583380e67ef93072294a7fac882fd7e7", MONEY_MARKET_V1),
    ("0xbd8e0def19aabbc3751b0b5ee0558cadffce759b", MONEY_MARKET_V1),
    ("0x158079ee67fce2f58472a96584a73c7ab9ac95c1", CTOKEN_V2),
    ("0xf5dce57282a584d2746faf1593d3121fcac444dc", CTOKEN_V2),
    ("0xb3319f5d18bc0d84dd1b4825dcde5d5f7266d407", CTOKEN_V2),
    ("0x4ddc2d193948926d02f9b1fe9e1daa0718270ed5", CTOKEN_V2),
    ("0x5d3a536e4d6dbd6114cc1ead35777bab948e3643", CTOKEN_V2),
    ("0x39aa39c021dfbae8fac545936693ac917d5e7563", CTOKEN_V2),
    ("0xf650c3d88d12db855b8bf7d11be6c55a4e07dcc9", CTOKEN_V2),
    ("0xc11b1268c1a384e55c48c2391d8d480264a3a7f4", CTOKEN_V2),
    ("0x6c8c6b02e7b2be14d4fa6022dfd6d75921d90e4e", CTOKEN_V2),
    ("0xface851a4921ce59e912d19329929ce6da6eb0c7", CTOKEN_V2),
    ("0x70e36f6bf80a52b3b46b3af8e106cc0ed743e8e4", CTOKEN_V2),
    ("0xc3d688b66703497daa19211eedff47f25384cdc3", COMET_V3),
    ("0xa17581a9e3356d9a858b789d68b4d866e593ae94", COMET_V3),
    ("0x3afdc9bca9213a35503b077a6072f3d0d5ab0840", COMET_V3),
)
