"""Operators on DataFrames: cleaning, dimensions, the fact, checks, the lock, holidays."""
