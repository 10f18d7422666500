"""Operators for training-data pipelines; nothing else in gridsight imports this subpackage."""
