"""Operators for preparing training text; their queries are in :mod:`tallyline.llm.registry`."""
