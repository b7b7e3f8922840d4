"""Clinical lakehouse analytics expressed as Spark DataFrame jobs."""

from carestrata.session import configure, local_session

__all__ = ["configure", "local_session"]
