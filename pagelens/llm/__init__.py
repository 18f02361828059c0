"""Operators of a training-data pipeline over ``documents``-shaped tables.

One module per operator; ``queries`` registers them. Nothing outside this
subpackage imports it. Operators take a DataFrame and column names, select the
columns they need first (so extra or clashing column names never matter) and
return new columns under their own names.
"""
