"""Training-data operators: quality, near duplicates, language, tokens, markup and contamination.

Nothing outside this subpackage imports it.
"""
