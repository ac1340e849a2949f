"""kiln.plans."""
