"""Scans, sinks and file manifests."""
