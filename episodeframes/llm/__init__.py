"""Operators for preparing text corpora: tokens, languages, duplicates, leaks, shards and archives."""
