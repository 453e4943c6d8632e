"""adsphere.plans."""
