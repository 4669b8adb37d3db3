"""Scans: files of a snapshot repository to typed tables."""
