"""Table and stream operators for PySpark: DataFrame in, DataFrame out."""
