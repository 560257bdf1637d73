"""Registered queries with their checking SQL."""
