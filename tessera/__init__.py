"""tessera: recommendation analytics and training-data operators as Spark DataFrame jobs.

Every public operator takes DataFrames and returns DataFrames; nothing is
collected to the driver except scalars and small, size-bounded metadata
(parameter grids, metric rows).
"""

from tessera.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
