"""threadglean: incremental text analytics over posts and comments, on Spark.

Every operator is a function from DataFrame(s) to DataFrame. See README.md for
the map from operator ids to modules.
"""

__version__ = "0.1.0"
