"""The operators applied to the test tables, with a SQL twin for each query."""
