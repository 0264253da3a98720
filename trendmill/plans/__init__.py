"""Silver, gold and analytics tables."""
