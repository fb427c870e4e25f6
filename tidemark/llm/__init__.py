"""Operators for text and for batches of free-entered rows. Nothing else in the package imports this subpackage."""
