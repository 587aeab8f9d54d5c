"""Operators for preparing language-model training data.

Every operator takes DataFrames and returns DataFrames. Work on texts runs in Arrow
batches (or in plain DataFrame functions where that is asked for); all grouping,
joining and sorting is Spark's. ``queries`` registers one query for each operator.
"""
