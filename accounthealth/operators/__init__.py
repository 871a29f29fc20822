"""Operators: the 21 models, the quality audit, readouts, workspace and queue views."""
