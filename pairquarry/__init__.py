"""Pair mining, labelling and audit over review history, as Spark DataFrames."""
