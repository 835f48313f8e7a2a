"""lapdeck: session-structured timing analytics as Spark DataFrame operators.

Sub-packages
------------
functions   column-level helpers (null normalisation, durations, keys, domains)
sources     scans, manifests and sinks (parquet / csv / partitioned writes)
operators   table operators: sequences, results, catalog, validation, checks,
            planning, changes
plans       end-to-end jobs and the query set registered for the driver
streaming   incremental refresh driven by Structured Streaming
"""

__version__ = "0.1.0"
