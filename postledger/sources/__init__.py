"""Readers: raw scrape files, landed partitions, tables of the model."""
