"""cabmeter: trip analytics as Spark DataFrame operators."""

import sys as _sys

# Functions this package hands to Python workers (mapInPandas) are pickled
# by value, so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
