"""Incremental file loads (availableNow file streams) and the weekly refresh."""
