"""Landed feeds, incremental pulls and stand-in tables."""
