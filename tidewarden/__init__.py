"""Adaptive traffic classification on Spark DataFrames."""

from tidewarden.schema import DetectorOptions, FEATURES

__all__ = ["DetectorOptions", "FEATURES"]
