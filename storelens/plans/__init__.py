"""Stored summaries and business measures."""
