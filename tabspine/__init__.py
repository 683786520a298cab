"""Spark-native operators and jobs for supervised work on tables."""

from tabspine.config import Config, Limits, Roles, TreeParams

__all__ = ["Config", "Limits", "Roles", "TreeParams"]
