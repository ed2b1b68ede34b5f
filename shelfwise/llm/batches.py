"""How many rows go to a Python worker at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Texts are long: so many rows of them are some MB, on the JVM's side and on the worker's.
ROWS = 2000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session sends at most ``ROWS`` rows a batch from now on."""
    conf = df.sparkSession.conf
    now = int(conf.get(_SETTING, "10000"))
    if now <= 0 or now > ROWS:
        conf.set(_SETTING, str(ROWS))
    return df
