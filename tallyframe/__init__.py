"""Reconciliation of several transcriptions of the same tables, on Spark DataFrames."""

VERSION = "0.2.0"
