"""Size of the batches that go to Python workers."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_PER_BATCH = 1_000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def long_texts(df: DataFrame) -> DataFrame:
    """``df``, with the session set to batches of at most ``ROWS_PER_BATCH`` rows, as rows hold whole texts.

    Spark's default of 10,000 rows a batch holds a batch of texts three times over: in the executor, in transit
    and in the worker.
    """
    conf = df.sparkSession.conf
    set_to = int(conf.get(_SETTING, "10000"))
    if set_to <= 0 or set_to > ROWS_PER_BATCH:
        conf.set(_SETTING, str(ROWS_PER_BATCH))
    return df
