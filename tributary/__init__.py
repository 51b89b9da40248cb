"""tributary: a retail sales lakehouse (bronze -> silver -> gold) on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own expressions; see ``tributary.operators`` for the silver/gold layer,
``tributary.sources`` for ingestion, ``tributary.streaming`` for
incremental runs and ``tributary.plans`` for the assembled pipeline.
"""

from tributary.session import build_session, checkpoint_dir, configure, scratch_path

__all__ = ["build_session", "checkpoint_dir", "configure", "scratch_path"]
