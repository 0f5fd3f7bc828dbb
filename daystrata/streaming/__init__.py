"""Incremental landing of new documents."""
