"""Slots, their state, and streams."""
