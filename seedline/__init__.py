"""Ranking and seeding of race results on PySpark DataFrames."""
