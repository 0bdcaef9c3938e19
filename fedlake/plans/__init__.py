"""fedlake.plans."""
