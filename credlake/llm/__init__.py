"""Operators for large-scale training-data work.

Nothing else in the library imports this subpackage.  ``queries.py`` names
one query per operator; each module states how it treats nulls, empty and
very long texts, ties, repeated rows, empty tables and clashing columns.
"""
