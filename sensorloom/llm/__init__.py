"""Operators for large text corpora: near-duplicates, scoring, scans, archives and mixing.

Nothing else in the library imports this subpackage.
"""
