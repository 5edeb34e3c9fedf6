"""Curbflow: fleet-tracking completion jobs on PySpark DataFrames."""
