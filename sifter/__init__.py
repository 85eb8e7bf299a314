"""sifter: Spark-native tabular discovery operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a small fit object
holding literals / small DataFrames), parametric in column names.
"""

__version__ = "0.1.0"
