"""Operators for preparing large text corpora.

Ten operators, one module each, and the queries that apply them to whole
tables (`queries`). Nothing outside this subpackage imports it.
"""
