"""adsphere.sources."""
