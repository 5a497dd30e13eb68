"""Relational operators: flatteners, joins, post-processing and analysis."""
