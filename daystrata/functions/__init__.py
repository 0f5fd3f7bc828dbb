"""Column functions.  All are compositions of Spark built-ins; there is no Python UDF."""
