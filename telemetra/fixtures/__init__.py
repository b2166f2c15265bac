"""Test inputs derived from the given tables by fixed rules; not part of the engine."""
