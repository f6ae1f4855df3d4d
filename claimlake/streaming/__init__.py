"""Incremental intake and outbox delivery."""
