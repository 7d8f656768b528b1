"""Small tables built on the JVM side.

``spark.createDataFrame(list)`` ships rows through a Python RDD, so every
later job over such a table starts Python workers.  Dictionaries and fixture
lookups are sent as one JSON string and expanded with ``from_json`` and
``inline``: one expression whatever the number of rows, planned and executed
entirely in the JVM.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _plain(v, dt: T.DataType):
    """A value as JSON has it; structs by field name."""
    if v is None:
        return None
    if isinstance(dt, T.ArrayType):
        return [_plain(x, dt.elementType) for x in v]
    if isinstance(dt, T.StructType):
        get = v.get if isinstance(v, dict) else dict(zip(dt.names, v)).get
        return {f.name: _plain(get(f.name), f.dataType) for f in dt.fields}
    if isinstance(dt, T.MapType):
        return {k: _plain(x, dt.valueType) for k, x in v.items()}
    return v


def local_df(spark: SparkSession, rows, schema: str | T.StructType) -> DataFrame:
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if not isinstance(st, T.StructType):
        raise ValueError("schema must be a struct")
    text = json.dumps([_plain(tuple(r), st) for r in rows], ensure_ascii=False)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(st))))
