"""Operators that prepare text for training language models. Nothing else in histkit imports this package."""

import sys

from pyspark import cloudpickle

# Executors need not have this package: what a task uses of it is sent along with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
