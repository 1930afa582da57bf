"""Spark-native table reconciliation, load audits and change-log replay.

Everything is a DataFrame in and a DataFrame out; see README.md for the map
from capability to function.
"""

__version__ = "0.1.0"
