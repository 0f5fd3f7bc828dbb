"""Composite plans: the view set, model jobs, and the relations derived from the sample tables."""
