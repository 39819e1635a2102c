"""Keyed reductions, keyed merges and audits."""
