"""Readers and writers: raw documents, activities, visit history, places, calendar spine."""
