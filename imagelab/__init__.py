"""Labelled image collections as Spark DataFrames: scan, clean, embed, train, log and score."""
