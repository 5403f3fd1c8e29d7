"""Terrain, trail and map-feature analytics expressed as Spark DataFrame plans."""
