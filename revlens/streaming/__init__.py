"""Incremental variants of batch operators for file streams."""
