"""Batch operators over changelogs. All are plain DataFrame expressions."""
