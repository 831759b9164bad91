"""tillflow: daily shop-sales marts as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or writes one); nothing
runs at import time.  Sub-packages:

* ``sources``    driver tables -> retail model, CSV drop files, header gate,
                 file manifest, JDBC
* ``operators``  enrichment joins, monthly marts, rank / incentive, ledger
* ``functions``  column expressions shared by the operators
* ``plans``      sinks, the batch run, scratch locations, the query catalog
* ``streaming``  availableNow file stream around the batch ingest

Functions that run in Python workers are shipped by value, so the workers need
no copy of the package on their import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["schema"]
