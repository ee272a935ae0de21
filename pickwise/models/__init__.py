"""Factorization-machine models: vectors as tables, dense layers as small arrays."""
