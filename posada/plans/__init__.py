"""Whole-table work: listings, reviews, calendar, profile and the complete run."""
