"""alpina: Spark-native operators for environmental landing → bronze → silver data flows.

Every operator is a function from DataFrame(s) to DataFrame, or a Column expression,
so Catalyst sees one plan from scan to sink.
"""

__version__ = "0.1.0"
