"""loomkit.functions."""
