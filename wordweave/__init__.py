"""Text-corpus analytics on Spark DataFrames.

Term counts, stop words, inverted indexes, cleaned line sets and set-similarity
joins.  Every operator takes DataFrames and returns DataFrames.
"""
