"""JDBC sources and sinks.

Reads are split over a numeric or time column, so one table is read by many
tasks. Filters reach the database; a maximum has to be asked for as a query,
since it is not pushed down.
"""


def connection(url, driver=None, user=None, password=None):
    """Options every read and write shares."""
    options = {"url": url, "driver": driver, "user": user, "password": password}
    return {k: v for k, v in options.items() if v is not None}


def scan_options(table, partition_column=None, lower=None, upper=None, partitions=None,
                 fetch_size=10_000):
    options = {"dbtable": table, "fetchsize": str(fetch_size)}
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options |= {"partitionColumn": partition_column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def mark_query(table, ts="created_utc"):
    """One-row query for the largest epoch of a table."""
    return f"SELECT MAX(EXTRACT(EPOCH FROM {ts})) AS mark FROM {table}"


def new_rows_query(table, mark, ts="created_utc"):
    """Rows strictly after `mark` as a derived table, filtered by the database."""
    return f"(SELECT t.* FROM {table} t WHERE EXTRACT(EPOCH FROM t.{ts}) > {float(mark)!r}) unread"


def read_table(spark, conn, table, **split):
    return spark.read.format("jdbc").options(**conn, **scan_options(table, **split)).load()


def read_mark(spark, conn, table, ts="created_utc"):
    """Largest stored epoch; 0 for an empty table."""
    row = spark.read.format("jdbc").options(**conn, query=mark_query(table, ts)).load().first()
    return float(row[0]) if row and row[0] is not None else 0.0


def read_new_rows(spark, conn, table, mark, ts="created_utc", **split):
    return read_table(spark, conn, new_rows_query(table, mark, ts), **split)


def append_table(df, conn, table, partitions=None, batch_size=5_000):
    """Append; the database refuses a stored key. `partitions` bounds the number
    of connections."""
    options = {**conn, "dbtable": table, "batchsize": str(batch_size)}
    if partitions is not None:
        options["numPartitions"] = str(partitions)
    df.write.format("jdbc").options(**options).mode("append").save()
