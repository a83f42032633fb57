"""Readers: delimited files, landing folders, descriptors, schema files, JSON and Kafka."""
