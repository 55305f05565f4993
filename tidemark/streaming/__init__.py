"""Streaming forms: event time, joins, state and running queries."""
