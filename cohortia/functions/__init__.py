"""Column-level helpers (calendar, ratios, formatting) and the p-value UDFs."""
