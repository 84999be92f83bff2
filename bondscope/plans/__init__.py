"""Whole reports."""
