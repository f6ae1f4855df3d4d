"""Intake: files and interchange lines to typed tables."""
