"""Reusable cohort/time-series operators."""
