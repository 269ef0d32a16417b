"""Structured Streaming jobs: file ingest, master upsert, receipts and inventory."""
