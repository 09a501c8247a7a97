"""loomkit.plans."""
