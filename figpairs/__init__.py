"""figpairs — figure–caption dataset building on Spark."""

import sys as _sys

# Functions that run inside Python tasks (unpack, parse, pack) are shipped by
# value, so executors need not have this package installed or on their path.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without the hook
    pass
