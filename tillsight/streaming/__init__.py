"""Incremental ingestion with Structured Streaming.

The reference has no streaming operator; its only repetition mechanism is a
full truncate-and-reload of the raw tables. ``landing`` offers the same raw
load (U05 with the U07 count check) incrementally: new CSV files in a landing
folder are typed and appended exactly once per file.
"""
