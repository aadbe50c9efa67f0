"""Operators for preparing large text corpora.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds
its queries when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
