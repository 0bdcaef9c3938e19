"""fedlake.streaming."""
