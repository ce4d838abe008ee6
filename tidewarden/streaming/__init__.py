"""Streaming jobs: keyed exact detection and micro-batch mixing."""
