"""Training-data operators: joins, dedup, mixing, packing, filters, archives.

Nothing else in the library imports this subpackage; its queries are
registered by ``__spark_entry__.py`` when it can be imported.
"""

import sys

from pyspark import cloudpickle

# functions travel to the executors by value: no copy of the package is needed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
