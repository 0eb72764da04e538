"""Scans and sinks for trips, models and scratch space."""
