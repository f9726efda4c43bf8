"""Readers and writers: landed files, snapshot tables, catalog administration, the bars adapter."""
