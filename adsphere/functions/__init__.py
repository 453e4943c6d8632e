"""adsphere.functions."""
