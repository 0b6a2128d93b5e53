"""Training-data operators: decontamination, toxicity, source mixing, chat formatting,
nearest neighbours, HTML extraction, token counts, language ID, n-gram Jaccard join and
not-modified revisit resolution. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
