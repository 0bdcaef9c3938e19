"""fedlake.sources."""
