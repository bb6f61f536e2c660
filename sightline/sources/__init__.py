"""Batch tables, JSON lines, JDBC dimensions and streams (files, or a topic by option)."""
