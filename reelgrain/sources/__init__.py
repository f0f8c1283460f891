"""Readers: object listings, discovery, sidecars, catalogues, topics."""
