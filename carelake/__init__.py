"""carelake: hospital-network analytics as plain Spark DataFrame jobs."""

from carelake.core import Core

__all__ = ["Core"]
