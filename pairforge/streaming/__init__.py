"""Incremental (file-stream) jobs."""
