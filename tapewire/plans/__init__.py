"""Whole jobs, each one lazy plan."""
