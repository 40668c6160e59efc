"""Reusable DataFrame operators (ordinals, latest-by-key, keyed updates, ...)."""
