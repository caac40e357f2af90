"""Warehouse sync and reconciliation as plain Spark DataFrame operators."""
