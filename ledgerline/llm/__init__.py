"""Training-data operators: similarity joins, scoring, archives, packing, decontamination, search.

Nothing else in the library imports this package; ``queries`` registers its queries.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
