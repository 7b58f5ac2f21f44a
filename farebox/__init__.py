"""farebox: Spark-native trip analytics and dataset building.

Functions take and return DataFrames; see README.md for the operator map.
"""

__version__ = "0.1.0"
