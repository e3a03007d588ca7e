"""Readers of landed files, payloads and dimensions."""
