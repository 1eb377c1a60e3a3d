"""Detector-measurement analytics on Spark: load, link, report."""
