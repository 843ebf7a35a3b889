"""Operators for preparing training data for language models, each a function from DataFrames to DataFrames."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions are sent to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
