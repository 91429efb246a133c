"""Adapters over the driver tables, registered queries and their oracle SQL."""
