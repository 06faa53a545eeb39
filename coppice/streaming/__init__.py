"""Scoring of arriving rows."""
