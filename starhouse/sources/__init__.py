"""Feeds in, tables and snapshots out."""
