"""Operators for training-data pipelines over text corpora.

One module per operator; ``queries`` registers them.  Nothing else in the
library imports this package.
"""
