"""Operators of a training-data pipeline: filters, deduplication, tokenisation, extraction.

Every operator takes and returns DataFrames.  Nothing else in the library
imports this subpackage.
"""
