"""duelframe: Spark-native operators for two-sided contest data and dated careers.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for scalar helpers) and only builds a lazy plan; nothing is
collected unless the function documents it.
"""

__version__ = "0.1.0"
