"""Incremental pick-up of contact-link sheets."""
