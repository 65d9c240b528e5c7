"""Operations of a large-scale training-data pipeline, one module each.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. The
functions that run inside Python workers are shipped by value, so executors
need only pyspark, numpy and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
