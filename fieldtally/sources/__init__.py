"""Readers: raw tables, dimension files and landed service responses."""
