"""Feature engineering and data quality on Spark."""

from .session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
