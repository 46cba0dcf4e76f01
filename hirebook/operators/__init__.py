"""Report operators: pure functions from DataFrames and parameters to a
DataFrame, grouped by business area (rental, profitability, recovery,
ledger, statements, integrity, payroll, depreciation)."""
