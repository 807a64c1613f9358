"""Warehouse operators on Spark DataFrames: staging, vault, history, marts, quality, ingest."""
