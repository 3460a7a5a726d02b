"""Incident warehouse on Spark: scan, clean, canonicalise, check, model and report."""
