"""corpusprep: Spark-native preparation and scoring of speech-transcript corpora.

Every operator takes and returns a DataFrame or a Column.  Random choices
come from md5 draws of (seed, purpose, key) so results never depend on how
the data happens to be partitioned.
"""

import sys as _sys

from corpusprep.session import checkpoint_dir, get_spark

# Ship the library's code inside each Python task (pandas functions, user
# batch functions) instead of requiring it to be installed on every executor.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler: install the package on executors
    pass

__all__ = ["get_spark", "checkpoint_dir"]
