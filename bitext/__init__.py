"""Spark-native bitext curation, batch translation and MT evaluation."""

import sys as _sys

__version__ = "0.1.0"

# Python workers may not have this package installed: ship the few Python
# helpers (GBK repair, model predictors) by value inside the pickled UDFs.
try:  # pragma: no cover - depends on the PySpark build
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
