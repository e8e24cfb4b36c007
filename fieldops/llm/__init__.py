"""Operators for preparing training data: mixing, quality, search, de-duplication, packing, scoring.

Nothing outside this folder imports it; ``__spark_entry__.py`` registers its queries if it is there.
"""
