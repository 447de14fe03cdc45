"""Customer value and churn analytics expressed as Spark jobs."""

from patronlens.config import RunConfig

__all__ = ["RunConfig"]
