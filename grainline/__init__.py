"""grainline — table preparation and data quality as Spark DataFrame operators.

Modules:

* ``grainline.operators`` — predicates, clean, impute (incl. exact KNN), scale,
  encode, features, outliers (incl. isolation forest), selection, reduce (PCA), custom
* ``grainline.sources`` / ``grainline.sinks`` — readers and writers
* ``grainline.plans`` — validation rule suites, profiles, spec runner, run history
* ``grainline.streaming`` — row-local and fitted operators on Structured Streaming
* ``grainline.functions`` — exact distributed quantiles, two-level ordering, helpers
"""

from .session import ensure_checkpoint_dir, get_spark, ship_package  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir", "ship_package"]
