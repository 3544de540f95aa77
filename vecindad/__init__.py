"""Building-charge analytics on Spark.

The package works on DataFrames throughout.  See the README for a tour:

* ``vecindad.sources``    file and table readers
* ``vecindad.functions``  column functions (amounts, dates, text)
* ``vecindad.operators``  reusable DataFrame steps (joins, costs, interest ...)
* ``vecindad.plans``      whole jobs (imports, monthly charges, reports)
* ``vecindad.sinks``      table and XML writers
* ``vecindad.streaming``  continuous intake of payment files
"""

__version__ = "0.1.0"
