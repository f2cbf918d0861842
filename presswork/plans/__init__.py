"""Helpers that shape plans: lineage cuts, table loading."""
