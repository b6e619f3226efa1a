"""Structured Streaming jobs: topic to files, new raw files to Bronze."""
