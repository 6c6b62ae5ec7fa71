"""Layers over the test tables, and one query with its SQL per operator."""
