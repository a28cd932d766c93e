"""corvane: acoustic-monitoring analytics on PySpark DataFrames."""
