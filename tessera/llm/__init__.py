"""Operators for training-data pipelines (quality, URL rules, token stores,
similarity joins, mixing, sharding, chat formatting, packing).

Nothing else in the library imports this subpackage."""
