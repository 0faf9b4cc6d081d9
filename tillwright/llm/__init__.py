"""Operators for preparing training data: filtering, dedup, tokenizing, packing and sharding."""
