"""Readers, writers and the projections that turn given tables into contracts."""
