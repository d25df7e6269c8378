"""Operators on texts and long sequences for training data; nothing else in the library imports this part."""
