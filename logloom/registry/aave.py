"""Aave V1, V2, V3 lending pools."""

from .model import define

# Event signatures, their Keccak-256 hashes, field names and contract addresses.
BORROW_V1 = define(
    "aave", "v1", "Borrow",
    "Borrow(address,address,uint256,uint256,uint256,uint256,uint256,uint16,uint256)",
    "0x1e77446728e5558aa1b7e81e0cdab9cc1b075ba893b740600c76a315c2caa553",
    "reserve address, user address, referral uint16",
    "amount uint256, borrow_rate_mode uint256, borrow_rate uint256, origination_fee uint256, "
    "borrow_balance_increase uint256, timestamp uint256",
)
BORROW_V2 = define(
    "aave", "v2", "Borrow",
    "Borrow(address,address,address,uint256,uint256,uint256,uint16)",
    "0xc6a898309e823ee50bac64e45ca8adba6690e99e7841c45d754e2a38e9019d9b",
    "reserve address, on_behalf_of address, referral uint16",
    "user address, amount uint256, borrow_rate_mode uint256, borrow_rate uint256",
)
BORROW_V3 = define(
    "aave", "v3", "Borrow",
    "Borrow(address,address,address,uint256,uint8,uint256,uint16)",
    "0xb3d084820fb1a9decffb176436bd02558d15fac9b0ddfed8c465bc7359d7dce0",
    "reserve address, on_behalf_of address, referral uint16",
    "user address, amount uint256, interest_rate_mode uint8, borrow_rate uint256",
)
REPAY_V1 = define(
    "aave", "v1", "Repay",
    "Repay(address,address,address,uint256,uint256,uint256,uint256)",
    "0xb718f0b14f03d8c3adf35b15e3da52421b042ac879e5a689011a8b1e0036773d",
    "reserve address, user address, repayer address",
    "amount_minus_fees uint256, fees uint256, borrow_balance_increase uint256, timestamp uint256",
)
REPAY_V2 = define(
    "aave", "v2", "Repay",
    "Repay(address,address,address,uint256)",
    "0x4cdde6e09bb755c9a5589ebaec640bbfedff1362d4b255ebf8339782b9942faa",
    "reserve address, user address, repayer address",
    "amount uint256",
)
REPAY_V3 = define(
    "aave", "v3", "Repay",
    "Repay(address,address,address,uint256,bool)",
    "0xa534c8dbe71f871f9f3530e97a74601fea17b426cae02e1c5aee42c96c784051",
    "reserve address, user address, repayer address",
    "amount uint256, use_a_tokens bool",
)
LIQUIDATION_V1 = define(
    "aave", "v1", "LiquidationCall",
    "LiquidationCall(address,address,address,uint256,uint256,uint256,address,bool,uint256)",
    "0x56864757fd5b1fc9f38f5f3a981cd8ae512ce41b902cf73fc506ee369c6bc237",
    "collateral address, reserve address, user address",
    "purchase_amount uint256, liquidated_collateral_amount uint256, accrued_borrow_interest uint256, "
    "liquidator address, receive_a_token bool, timestamp uint256",
)
LIQUIDATION_V2 = define(
    "aave", "v2", "LiquidationCall",
    "LiquidationCall(address,address,address,uint256,uint256,address,bool)",
    "0xe413a321e8681d831f4dbccbca790d2952b56f977908e45be37335533e005286",
    "collateral_asset address, debt_asset address, user address",
    "debt_to_cover uint256, liquidated_collateral_amount uint256, liquidator address, receive_a_token bool",
)
LIQUIDATION_V3 = define(
    "aave", "v3", "LiquidationCall",
    "LiquidationCall(address,address,address,uint256,uint256,address,bool)",
    "0xe413a321e8681d831f4dbccbca790d2952b56f977908e45be37335533e005286",
    "collateral_asset address, debt_asset address, user address",
    "debt_to_cover uint256, liquidated_collateral_amount uint256, liquidator address, receive_a_token bool",
)
DEPOSIT_V1 = define(
    "aave", "v1", "Deposit",
    "Deposit(address,address,uint256,uint16,uint256)",
    "0xc12c57b1c73a2c3a2ea4613e9476abb3d8d146857aab7329e24243fb59710c82",
    "reserve address, user address",
    "amount uint256, timestamp uint256",
)
DEPOSIT_V2 = define(
    "aave", "v2", "Deposit",
    "Deposit(address,address,address,uint256,uint16)",
    "0xde6857219544bb5b7746f48ed30be6386fefc61b2f864cacf559893bf50fd951",
    "reserve address, onBehalfOf address, referral uint16",
    "user address, amount uint256",
)
DEPOSIT_V3 = define(
    "aave", "v3", "Deposit",
    "Supply(address,address,address,uint256,uint16)",
    "0x2b627736bca15cd5381dcf80b0bf11fd197d01a037c52b927a881a10fb73ba61",
    "reserve address, onBehalfOf address, referralCode uint16",
    "user address, amount uint256",
)
WITHDRAW_V1 = define(
    "aave", "v1", "Withdraw",
    "Withdraw(address,address,uint256,uint256)",
    "0xf341246adaac6f497bc2a656f546ab9e182111d630394f0c57c710a59a2cb567",
    "reserve address, user address",
    "amount uint256, timestamp uint256",
)
WITHDRAW_V2 = define(
    "aave", "v2", "Withdraw",
    "Withdraw(address,address,address,uint256)",
    "0x3115d1449a7b732c986cba18244e897a450f61e1bb8d589cd2e69e6c8924f9f7",
    "reserve address, user address, to address",
    "amount uint256",
)
WITHDRAW_V3 = define(
    "aave", "v3", "Withdraw",
    "Withdraw(address,address,address,uint256)",
    "0x3115d1449a7b732c986cba18244e897a450f61e1bb8d589cd2e69e6c8924f9f7",
    "reserve address, user address, to address",
    "amount uint256",
)

POOL_V1 = (DEPOSIT_V1, WITHDRAW_V1, BORROW_V1, REPAY_V1, LIQUIDATION_V1)
POOL_V2 = (DEPOSIT_V2, WITHDRAW_V2, BORROW_V2, REPAY_V2, LIQUIDATION_V2)
POOL_V3 = (DEPOSIT_V3, WITHDRAW_V3, BORROW_V3, REPAY_V3, LIQUIDATION_V3)

CONTRACTS = (
    ("0x398ec7346dcd622edc5ae82352f02be94c62d119", POOL_V1),
    ("0x2f60c3eb259d63dcca81fde7eaa216d9983d7c60", POOL_V1),
    ("0x633c23fc727e8afd3546d0cf86c8644f0fff16a6", (DEPOSIT_V1, WITHDRAW_V1, BORROW_V1, REPAY_V1)),
    ("0x5f93ad786a1330d2ec97926f073259f70375d146", (DEPOSIT_V1,)),
    ("0x7d2768de32b0b80b7a3454c06bdac94a69ddc7a9", POOL_V2),
    ("0x87870bca3f3fd6335c3f4ce8392d69350b4fa4e2", POOL_V3),
)
