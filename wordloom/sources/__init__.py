"""Readers: page tables, crawl archives, posting runs."""

import sys

from pyspark import cloudpickle

# The readers' task functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
