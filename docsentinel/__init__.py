"""docsentinel: Spark-native analytics over identity-document control events.

Raw "document controlled" and "document created" event tables are staged into
typed DataFrames, joined, and rolled up into the datasets fraud analysts read:
a detailed fact, status counts per dimension, a dense monthly pivot per control,
score-level results with JSON metrics, month-over-month trends and a snapshot
history. Everything is expressed with DataFrame operators and built-in column
functions so Catalyst plans it and the work runs distributed.
"""

from docsentinel.config import Config

__all__ = ["Config"]
__version__ = "0.1.0"
