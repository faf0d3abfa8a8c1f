"""Count regression with excess zeros on Spark DataFrames.

Typed loading, segment filters, nearest-neighbour imputation, feature views,
frozen encoders, maximum-likelihood count models, calibration and rank metrics.
"""
