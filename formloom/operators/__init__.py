"""Operators over layouts, records, events and texts."""
