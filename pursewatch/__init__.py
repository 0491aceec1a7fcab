"""Wallet-risk analytics as plain PySpark: DataFrames in, DataFrames out."""
