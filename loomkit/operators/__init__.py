"""loomkit.operators."""
