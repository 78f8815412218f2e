"""Arrival stream."""
