"""Concept pipelines (cohort, ventilation, daily series, first-day, scores, merge)."""
