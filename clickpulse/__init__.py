"""clickpulse: Spark-native shopping-behaviour and ad-click analytics.

Every operator takes and returns a ``pyspark.sql.DataFrame``; the work runs
on the executors (Catalyst / AQE pick the physical plan). Layout:

- ``sources``   readers: parquet tables, the clickstream adapter, ad-log lines, job parameters
- ``functions`` column expressions (id lists, percentages, JSON pair lists, time keys)
- ``operators`` DataFrame -> DataFrame operators (the batch half of every job)
- ``plans``     end-to-end jobs with parameters and a run id
- ``streaming`` Structured Streaming forms (guard, running counts, top-N, trend)
- ``sinks``     writers: keyed upsert, snapshot replace, JDBC append, managed tables
"""

from clickpulse.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
