"""Operators for preparing training data, and the registered queries over them."""
