"""Cubes, insights and data-quality jobs as plain PySpark DataFrame operations."""
