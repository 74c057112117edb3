"""Folders that several test modules read."""

SMALL = "/root/testdata/sf0.001"
