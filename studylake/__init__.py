"""Layered learning analytics on Spark: ingest, clean, model, check, analyse."""
