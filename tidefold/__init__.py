"""tidefold: change-data-capture analytics written as Spark jobs.

Land change pages, normalise them into an append-only change log, fold the log
into current-state tables, publish what changed, and monitor the whole thing.
Every step is a DataFrame plan; nothing depends on one process holding the data.
"""

__version__ = "0.1.0"
