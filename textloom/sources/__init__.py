"""Readers and writers of tables, documents, units and traces."""
