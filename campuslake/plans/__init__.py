"""Whole runs: the lakehouse stages, and the queries that exercise every operator."""
