"""Shoreline: file ingestion and event routing expressed as Spark DataFrame operators."""
