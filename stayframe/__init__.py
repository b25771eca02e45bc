"""stayframe: cohort and ICU time-series analytics as Spark DataFrame jobs."""
