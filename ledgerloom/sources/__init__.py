"""Readers of files, tables, queries and landed JSON pages."""
