"""Spark-first curation engine: sources, scalar functions, operators, plans, streams."""
