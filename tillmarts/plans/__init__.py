"""Composed models: each is a function from input frames to one result frame."""
