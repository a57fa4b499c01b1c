"""Recurring-revenue analytics expressed as Spark DataFrame operators."""

from recurra.config import MetricConfig, Tables

__all__ = ["MetricConfig", "Tables"]
