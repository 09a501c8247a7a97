"""loomkit: a Spark-native engine for text-to-vector-graphics training corpora.

Every operator is a function from ``Column`` to ``Column`` or from
``DataFrame`` to ``DataFrame``; the heavy work runs on Spark executors.
"""

__version__ = "0.1.0"
