"""sliceflow: slice-apply jobs, run-history analytics and event-stream jobs on
PySpark DataFrames, SQL and Structured Streaming."""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle sliceflow functions by value, so Python workers run them even
    where the package is not installed (e.g. a driver started elsewhere).
    Shipping the package with ``--py-files`` works as well."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover - Spark is required anyway
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
