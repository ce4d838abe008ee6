"""Readers, writers, codecs and table derivations."""
