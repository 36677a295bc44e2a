"""Readers and writers: raw blocks, items, exports and keyed tables."""
