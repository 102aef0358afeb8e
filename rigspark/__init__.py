"""Volumetric-capture analytics on Spark."""
