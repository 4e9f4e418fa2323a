"""Operators on DataFrames: projections, sampling, metrics, tree ensembles, models, tuning."""
