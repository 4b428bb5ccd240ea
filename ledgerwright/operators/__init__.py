"""Ledger operators: DataFrames in, DataFrames out, all budgets at once."""
