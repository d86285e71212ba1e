"""Training-data operators: packing, dedup, quality, scoring, filters, mixing.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is there.
"""
