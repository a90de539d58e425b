"""Presentation of query results: engine-neutral column types.

* integral columns -> BIGINT, fractional (decimal / float) -> DOUBLE (money is summed in exact decimal first);
* timestamps -> ``yyyy-MM-dd HH:mm:ss.SSSSSS`` text, dates -> ``yyyy-MM-dd`` text (engines hand dates and
  timestamps to pandas in different types); the open-version sentinel ``9999-12-31 23:59:59`` -> NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.session import FAR_FUTURE, ts_lit


def finalize(df: DataFrame) -> DataFrame:
    cols = []
    far = ts_lit(FAR_FUTURE)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType, T.DoubleType)):
            c = c.cast("double")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            ts = c.cast("timestamp_ntz")
            c = F.when(ts != far, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
