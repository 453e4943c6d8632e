"""adsphere.operators."""
