"""Registered query plans (Spark) and their SQL oracles, plus composite jobs."""
