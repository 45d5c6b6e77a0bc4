"""Churn features and propensity models as Spark jobs."""

from ebbtide.config import ChurnConfig

__all__ = ["ChurnConfig"]
