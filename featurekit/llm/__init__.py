"""Operators for training-data pipelines over text.  Nothing outside this subpackage imports it."""
