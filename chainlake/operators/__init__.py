"""Relational derivations over chain tables."""
