"""Metadata-driven ingest and upsert on Spark DataFrames."""
