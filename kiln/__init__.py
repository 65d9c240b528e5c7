"""kiln: Spark-native tabular preparation and regression toolkit.

Every operator is a DataFrame projection or aggregation addressed by column
name. Fitting an estimator runs aggregation jobs and returns a model that
holds only literals and small, size-checked parameter tables; transforming
is a projection plus (broadcast) lookup joins.
"""

from kiln.session import get_session, load_tables, materialize

__all__ = ["get_session", "load_tables", "materialize"]
