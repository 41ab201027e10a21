"""qaflow: retrieval question-answering data work as Spark DataFrame operators.

Every public function takes and returns DataFrames (or Columns, for the
scalar functions in :mod:`qaflow.functions`).  The heavy work -- chunking,
encoding, similarity joins, scoring -- runs inside Spark tasks; nothing is
collected to the driver except size-checked, bounded side inputs
(centroids, one block of query vectors).
"""

from qaflow.session import get_spark, checkpoint_dir, scratch_path

__all__ = ["get_spark", "checkpoint_dir", "scratch_path"]
