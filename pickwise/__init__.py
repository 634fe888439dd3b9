"""pickwise — draft and early-match analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a lazy DataFrame; the caller owns
the session and decides when to act.  Layout:

* ``sources``    declared schemas, file loaders, fixture views over the driver tables
* ``functions``  reusable column expressions (labels, pair arrays, bands, rounding)
* ``operators``  draft, pair, series, recommendation, ML and sink operators
* ``plans``      composite feature tables and plan-inspection helpers
"""

__version__ = "0.1.0"
