"""Pairloom: interaction-dataset analytics on Spark DataFrames."""
