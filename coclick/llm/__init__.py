"""Operators for preparing text corpora: fingerprints, filters, dedup, mixing, packing, token files.

Nothing outside this subpackage (and the corpus pipeline script) imports it.
"""
