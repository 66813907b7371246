"""Literal-frame builders in the landing contracts (missing fields are NULL)."""

from pyspark.sql import types as T

from quayside import contracts as K

SF001 = "/root/testdata/sf0.001"


def frame(spark, entity, rows):
    # files do not enforce NOT NULL, so fixtures may carry NULL keys
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in K.SCHEMAS[entity].fields])
    names = [f.name for f in schema.fields]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, schema)


def rows(df, *cols, order=None):
    df = df.select(*cols) if cols else df
    out = [r.asDict() for r in df.collect()]
    key = order or (cols[0] if cols else df.columns[0])
    return sorted(out, key=lambda r: (r[key] is None, r[key]))
