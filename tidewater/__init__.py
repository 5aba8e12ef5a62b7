"""tidewater: sensor-stream analytics (raw -> bronze -> silver -> gold) on plain Spark.

Every transform is a ``DataFrame -> DataFrame`` function that works the same on a
batch DataFrame and on a streaming one; the runner in ``tidewater.streaming`` picks
``spark.read`` or ``spark.readStream``.
"""

import sys

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run inside tasks (pandas UDFs, mapInPandas,
    applyInPandas) are pickled with their code, so executors need no installed copy of
    the package (the driver may import it from any folder)."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older pickler: executors then need the package installed
        pass


_ship_by_value()
