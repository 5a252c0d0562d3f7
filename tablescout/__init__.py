"""tablescout: Spark-native table profiling and join-path discovery.

Operators are DataFrame expressions over the caller's ``SparkSession``.
Most are lazy; join discovery, exact paths, histograms and k-means run jobs
when called. Nothing is collected to the driver except bounded scalars (a
histogram's min/max, k-means centres).
"""

__all__ = ["TableProfiler", "TableSet", "cast_categorical", "handle_input", "read_table"]


def __getattr__(name):
    if name in ("TableProfiler", "TableSet"):
        from tablescout.plans import tableset

        return getattr(tableset, name)
    if name in ("cast_categorical", "handle_input", "read_table"):
        from tablescout.sources import readers

        return getattr(readers, name)
    raise AttributeError(name)
