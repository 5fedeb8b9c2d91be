"""Whole jobs and the topics they read."""
