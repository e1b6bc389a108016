"""Expression, function and trait tables at scale on Spark, and the preparation of training corpora (llm)."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors with their code, so that clusters need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
