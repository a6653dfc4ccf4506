"""Customer-level feature engineering, profiling and churn modelling on Spark.

Every operator takes and returns ``pyspark.sql.DataFrame`` objects (or is a
``pyspark.ml`` Estimator/Model) so the work stays in Spark's planner and runs
on the cluster.  Sub-packages:

* ``sources``   – table loading with fallback, CSV/parquet sinks, dataset
  manifests, run records, model persistence.
* ``functions`` – column expressions (moments, dates, power transforms) and
  tail probabilities of the test statistics.
* ``operators`` – series features, profiling, association tests, outliers,
  skew, encoding, sampling, models, metrics, explanations.
* ``plans``     – composed preprocessing (fit once, apply anywhere) and the
  what-if price scenario.
* ``streaming`` – scoring of micro-batches with a fitted preprocessing +
  model.
"""

__version__ = "0.1.0"

# Functions of this package used inside pandas UDFs / applyInPandas / mapInPandas
# are shipped with the task (pickled by value), so Python workers do not need
# the package on their path (on a cluster it is still normally shipped with
# --py-files or installed as a wheel).
try:  # pragma: no cover - depends on the PySpark build
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
