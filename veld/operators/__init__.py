"""Operators on DataFrames: cleaning, profiling, quantiles, encoders, geo, selection."""
