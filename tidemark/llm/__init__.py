"""Operators for preparing training text: mixing, filtering, deduplication, decontamination, sharding."""
