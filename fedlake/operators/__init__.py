"""fedlake.operators."""
