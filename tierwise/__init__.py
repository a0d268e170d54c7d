"""tierwise: layered-warehouse operators expressed as PySpark DataFrame plans.

Sub-packages
------------
functions   column expressions with the source-database semantics (blank = NULL,
            NULL-ignoring concatenation, null ordering, safe division, ...)
sources     table catalog, scoped/windowed scans, sheets, schema mapping and the
            versioned Parquet table store
operators   merge / dedup / orphan sweep, reusable relational blocks, ingestion
            dispatch and reconciliation
plans       the driver queries over the test tables and the 21 data products
streaming   the optional incremental (availableNow) ingestion path
"""

__version__ = "0.1.0"
