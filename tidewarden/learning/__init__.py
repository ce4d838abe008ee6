"""Order-dependent learning: the numpy step run inside tasks and its two Spark drivers."""
