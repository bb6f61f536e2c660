"""Partition maintenance jobs."""
