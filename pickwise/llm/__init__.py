"""Training-data operators: toxicity, secrets, decontamination, quality, mixing,
near duplicates, language, token rollups, version fingerprints, tool calls, conversation
repair, hard negatives, line dedup.

Nothing else in the library imports this subpackage.  The functions that run
inside tasks are shipped by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
