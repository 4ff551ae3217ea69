"""Public-health analytics as Spark DataFrame and Structured Streaming jobs."""

from carelake.session import configure, shared_path

__all__ = ["configure", "shared_path"]
