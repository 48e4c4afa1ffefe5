"""Readers for record logs, Kafka topics and stored objects."""
