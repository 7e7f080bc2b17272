"""Whole plans: a folder to a chunk store, chunks to a dataset."""
