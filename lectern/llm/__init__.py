"""Operators for building training corpora: filtering, deduplication, tokenising, sharding."""
