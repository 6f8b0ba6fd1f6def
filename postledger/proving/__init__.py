"""Scrapes derived from generic tables, the queries run over them, and the SQL they must equal."""
