"""Small fixtures typed by hand."""


def rows(df, *order):
    """Rows as plain tuples, sorted by ``order`` (default: all columns)."""
    columns = order or df.columns
    got = [tuple(r) for r in df.collect()]
    index = [df.columns.index(c) for c in columns]
    return sorted(got, key=lambda r: tuple((r[i] is not None, r[i]) for i in index))


def table(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)
