"""Readers: text and columnar files, paged sources, relational databases, cursors."""
