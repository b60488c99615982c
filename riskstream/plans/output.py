"""Result shape at the comparison boundary.

Library functions return native types (TIMESTAMP, arrays, ...).  For the
cross-engine check every result is rendered in a portable shape: instants as
TIMESTAMP_NTZ in UTC wall time, decimals as double, string arrays as ``{a,b}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast(T.TimestampNTZType())
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat(F.lit("{"), F.array_join(c.cast("array<string>"), ","), F.lit("}"))
        cols.append(c.alias(f.name))
    return df.select(*cols)
