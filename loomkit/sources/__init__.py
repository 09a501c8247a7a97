"""loomkit.sources."""
