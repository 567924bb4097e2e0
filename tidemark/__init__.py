"""Metadata-driven ingestion and analytics on Spark DataFrames."""
