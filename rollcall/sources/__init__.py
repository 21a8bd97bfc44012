"""Readers that turn stored pages, JSON and driver tables into listing rows."""
