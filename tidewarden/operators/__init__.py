"""Aggregates, ordered operators, drift checks and session features."""
