"""Gridded agro-climate analytics on Spark: DataFrame in, DataFrame out."""

from gridagro.plans.prepare import Run, Sources, prepare

__all__ = ["Run", "Sources", "prepare"]
