"""martkit: build and maintain star-schema data marts with plain Spark DataFrames.

Every public function takes DataFrames and returns DataFrames; the Python driver
only builds logical plans.  Sub-packages:

* ``martkit.functions``  column expressions (cleansing, safe casts, date keys, column specs)
* ``martkit.operators``  DataFrame operators (lookups, SCD, dedup, reshape, facts, quality)
* ``martkit.sources``    raw readers and the snapshot store / audit log
* ``martkit.plans``      mart loaders, runners and the driver query catalogue
* ``martkit.streaming``  incremental (micro-batch) variants of the append operators
"""

__version__ = "0.1.0"
