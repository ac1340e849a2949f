"""kiln.functions."""
