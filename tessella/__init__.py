"""Spark-native analytics over spatial-omics tables: points, cell polygons and cell-by-gene counts as plain DataFrames."""
