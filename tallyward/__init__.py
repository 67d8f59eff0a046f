"""Payables adjudication as Spark DataFrame operators."""
