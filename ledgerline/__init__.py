"""Ledgerline: DataFrame operators for versioned usage records, baskets and live events.

Every operator takes DataFrames and returns a lazy DataFrame; Spark plans and runs the work.
"""
