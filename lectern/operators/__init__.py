"""Operators: DataFrame to DataFrame, generic in column names."""
