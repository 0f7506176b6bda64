"""Operators for preparing training text: extraction, tokenizing, filtering and deduplication.

Nothing else in the library imports this subpackage. Every operator takes and returns
DataFrames and keeps its own module; ``queries`` registers them.
"""
