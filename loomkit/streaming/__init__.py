"""loomkit.streaming."""
