"""Catalogue of multi-part image file headers, kept and queried with Spark."""
