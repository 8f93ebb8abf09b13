"""Dimensional loads and dense space-time panels on Spark."""
