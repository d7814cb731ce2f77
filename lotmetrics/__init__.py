"""Territorial panel analytics expressed as Spark DataFrame plans."""
