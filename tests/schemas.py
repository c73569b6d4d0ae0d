"""The full coin ledger, for rows made by hand."""

LEDGER = (
    "account_id string, date date, device string, platform string, first_use_date date, by_expiry array<struct<expiry_date: date, "
    "daily_free_topup: bigint, daily_paid_topup: bigint, daily_free_use: bigint, daily_paid_use: bigint, total_free_topup: bigint, "
    "total_paid_topup: bigint, total_free_topup_refunds: bigint, total_paid_topup_refunds: bigint, total_free_use: bigint, "
    "total_paid_use: bigint, total_free_returns: bigint, total_paid_returns: bigint, free_balance: bigint, paid_balance: bigint>>")
LEDGER_MEASURES = [
    "total_free_topup", "total_paid_topup", "total_free_topup_refunds", "total_paid_topup_refunds", "total_free_use",
    "total_paid_use", "total_free_returns", "total_paid_returns", "free_balance", "paid_balance"]
