def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def column(df, name):
    return sorted((r[name] for r in df.select(name).collect()), key=repr)


def one(spark, expr, value, dtype="string"):
    """Value of `expr` over the column x of a one-row frame."""
    return spark.createDataFrame([(value,)], f"x {dtype}").select(expr).first()[0]
