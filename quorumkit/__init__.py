"""Ensemble label analytics on Spark."""
