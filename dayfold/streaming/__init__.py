"""Incremental pick-up of raw documents."""
