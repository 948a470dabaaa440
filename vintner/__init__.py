"""Cohort value, payment risk and lifetime-value forecasting as Spark jobs."""
