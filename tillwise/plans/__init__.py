"""Operators put together: the analysis model, the registered queries, the report run."""
