"""Operators of a training-data pipeline over documents, embeddings and pages."""

import sys

from pyspark import cloudpickle

# Executors need no copy of the package: the functions that run in tasks are sent with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
