"""pairforge: a Spark-native engine for building, splitting, featurising and
scoring paired code/text datasets.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so Catalyst plans it, whole-stage codegen runs it and the
results do not depend on how the data is partitioned.
"""

__version__ = "0.1.0"
