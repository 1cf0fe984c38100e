"""Whole jobs: the operators chained from observations to metrics and gates."""
