"""ratelens — exploratory statistics for item/rating tables on Spark.

Every operator is a function ``DataFrame -> DataFrame`` parameterised by
column names.  Work runs as Spark SQL expressions, aggregates, joins and
windows; only finished, bounded aggregates (a few rows) ever reach the
driver, and only where a scalar special function (p-values) is needed.
"""

from ratelens.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
