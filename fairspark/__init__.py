"""fairspark: fair k-means clustering and word counts as Spark DataFrame jobs."""

from . import functions, operators, sources
from .session import ensure_checkpoint_dir, local_session

__all__ = ["functions", "operators", "sources", "ensure_checkpoint_dir", "local_session"]
