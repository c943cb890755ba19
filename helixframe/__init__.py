"""Cohort genetics on Spark."""
