"""Tabular learning on Spark: audit, profile, bin, train, score and report."""
