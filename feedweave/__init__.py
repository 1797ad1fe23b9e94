"""Unify heterogeneous feeds into one queryable table on Spark."""
