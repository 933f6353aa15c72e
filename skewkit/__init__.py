"""skewkit: skew-safe counting, Top-N, joins and offset-tracked streams on Spark DataFrames."""

__version__ = "0.1.0"
