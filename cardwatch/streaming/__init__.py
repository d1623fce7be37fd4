"""Scoring of transaction streams."""
