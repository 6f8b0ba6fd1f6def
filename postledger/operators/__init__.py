"""Operators over whole tables: grain, facts, dimensions, fingerprints and contracts."""
