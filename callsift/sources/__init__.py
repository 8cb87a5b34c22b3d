"""Readers for shards, files and notifications, and the table layer."""
