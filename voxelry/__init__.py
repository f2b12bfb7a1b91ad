"""Cohort analytics for 3-D image volumes held as Spark tables."""
