"""Design and evaluation of hybrid-capture probe panels over large genome collections, on Spark.

Sequences are DataFrames of (id, seq); alignments, depth segments and reports are
DataFrames too. Coordinates are 0-based and half-open inside the library and
1-based only in files.
"""
