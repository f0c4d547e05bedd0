"""Spark-native ETL operators and job-run analysis.

Every function takes and returns DataFrames or Columns; the caller owns the session.
"""
