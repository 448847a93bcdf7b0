"""Part of the floodmark package."""
