"""Composed plans: the job's stages over one input, the query catalog with
its SQL statement per query, and the end-to-end pipeline."""
