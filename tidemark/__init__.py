"""Regime analytics over multi-station sensor telemetry, expressed as Spark DataFrame operators."""

from tidemark.params import Params

__all__ = ["Params"]
