"""The same products from a stream of change rows."""
