"""ratecast: event-rate analytics and short-horizon forecasting on Spark DataFrames.

Every public operator takes and returns a lazy ``DataFrame``; nothing is collected
to the driver except one-row scalars (e.g. the ADF Gram matrix, a few dozen numbers).
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers (Arrow UDFs, grouped
    maps, the stream processor) need no installed copy of the package."""
    import sys
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: workers import the package
        pass


_ship_by_value()
