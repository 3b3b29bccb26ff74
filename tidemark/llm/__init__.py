"""Operators that prepare text for language-model training, each a function on DataFrames."""
