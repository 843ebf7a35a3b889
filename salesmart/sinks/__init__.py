"""Mart storage and the shared folder for intermediate tables."""
