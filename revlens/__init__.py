"""revlens: sales analytics as composable Spark DataFrame operators.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark SQL expressions, joins, aggregations and
windows, so Catalyst plans it and the work is spread over all keys at once.
"""

__version__ = "0.1.0"
