"""Sightline: streaming ingestion and lookup analytics over sighting events, on Spark."""

__version__ = "0.1.0"
