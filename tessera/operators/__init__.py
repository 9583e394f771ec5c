"""DataFrame-in, DataFrame-out operators."""

import sys  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

# Functions that run in tasks are pickled by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
