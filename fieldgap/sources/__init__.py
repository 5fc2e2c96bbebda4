"""Scans, sinks and the versioned warehouse."""
