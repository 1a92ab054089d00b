"""Whole runs: operators in order, one write per layer."""
