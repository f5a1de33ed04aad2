"""Training-data operators: packing, media, archives, filters, deduplication, tokens and scoring.

Nothing outside this folder imports it.
"""
