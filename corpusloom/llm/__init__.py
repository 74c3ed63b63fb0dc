"""Operators for training-data pipelines. Nothing else in corpusloom imports this subpackage."""
