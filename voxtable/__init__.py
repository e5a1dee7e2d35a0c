"""Slice-to-model analytics on Spark: slice tables in, one feature row per volume out."""

from voxtable.schemas import TensorLayout

__all__ = ["TensorLayout"]
