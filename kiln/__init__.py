"""kiln: Spark-native data preparation, data quality and feature engineering.

Every operator is a function ``DataFrame -> DataFrame`` (or a fit/transform
pair whose fitted state is a handful of scalars), so a whole run stays one
lazy Catalyst plan per output table.
"""

from kiln.session import get_spark, checkpoint_dir, cut_lineage

__all__ = ["get_spark", "checkpoint_dir", "cut_lineage"]
