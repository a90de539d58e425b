"""starloom — build and maintain dimensional warehouses on PySpark.

Layers:

* ``functions``  column-level helpers (cleaning, row hashes, surrogate keys, calendar attributes)
* ``operators``  DataFrame -> DataFrame building blocks (archive diff, dimensions, SCD-2, facts, quality, marts)
* ``sources``    readers and the staged, manifest-published warehouse writer
* ``plans``      specs that wire operators into a warehouse, the full and incremental runs, the query catalog
* ``streaming``  an ``availableNow`` trigger that feeds daily extracts into the incremental run

Operators never collect data rows to the driver; only ``sources`` / ``plans`` (and the dense-key operator)
trigger jobs.
"""

__version__ = "0.1.0"
