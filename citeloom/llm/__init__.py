"""Operators on texts for training data: packing, leaked evaluation items, personal information."""
