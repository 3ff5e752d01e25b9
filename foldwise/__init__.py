"""foldwise: a Spark-native library for tabular feature building, folds, scoring and metrics.

Every operator is a DataFrame expression, aggregate, window or join. Fitted state is a small
lookup table (or a short literal list) whose size is checked before it is broadcast.
"""

__version__ = "0.1.0"
