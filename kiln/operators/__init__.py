"""kiln.operators."""
