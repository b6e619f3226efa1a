"""Readers: the event topic, raw and Bronze JSONL files, catalog files, derived samples."""
