"""Operators of a training-data pipeline: sharding, quality, near-duplicates,
web archive derivatives, mixing, packing, language identification, token
counts and vector search. Nothing else in the package imports this folder."""
