"""Names and codes that must equal those of the messages and the ledger."""

# Payment gateway of free replacement orders.
ZERO_CHARGE = "thrive_zero_charge"

# JSON keys of store cash in the messages.
CASH = "thrive_cash"
CASH_APPLIED = "thrive_cash_applied_details"
CASH_EARNED = "thrive_cash_earned_details"

# Ledger name of the store-cash discount posting (300/62).
CASH_DISCOUNT = "Thrive Cash Discount"

# Source and target time zone of GL and sale dates.
UTC = "UTC"
LEDGER_ZONE = "America/Los_Angeles"
