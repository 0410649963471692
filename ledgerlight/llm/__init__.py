"""Training-data operators: mixing, token counts, pseudonyms, near duplicates,
quality rules, decontamination, URL reputation, language-model scores,
toxicity and a quality classifier.

Nothing else in the library imports this subpackage.  Functions that run
inside tasks are shipped by value, so executors need only Python, numpy and
pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
