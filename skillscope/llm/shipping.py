"""Makes the package's Python functions run on executors that do not have it installed, on batches of bounded size."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import skillscope.llm

BATCH_BYTES = 8 << 20  # of rows in one Arrow batch: both ends of the pipe hold a batch more than once
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship() -> None:
    """Send this package's functions with the tasks instead of by name."""
    cloudpickle.register_pickle_by_value(skillscope.llm)


def bound_batches(spark: SparkSession) -> None:
    """Send whole texts in Arrow batches of ``BATCH_BYTES``, unless the session names a size of its own.

    By Spark's default a batch of texts reaches 64 MB, in each task's JVM and in its Python worker.
    """
    if spark.conf.get(_LIMIT, None) is None:
        spark.conf.set(_LIMIT, str(BATCH_BYTES))
