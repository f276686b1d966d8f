"""Yield analytics over sensor matrices and pass/fail logs, as Spark DataFrame functions."""

from waferlens.config import PipelineConfig

__all__ = ["PipelineConfig"]
