"""Marketplace order analytics on Spark: raw, bronze, silver and gold tables, reporting marts and checks."""
