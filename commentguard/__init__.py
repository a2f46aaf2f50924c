"""commentguard: Spark-native analytics for monitoring harmful language in comment streams.

Every public operator takes and returns DataFrames; the heavy lifting is done
by Catalyst-planned native expressions, broadcast joins of small lexicons and
a bounded number of shuffles.
"""

__version__ = "0.1.0"
