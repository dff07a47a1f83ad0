"""Consolidation of dated, amending documents on Spark DataFrames."""
