"""Registered queries over the given tables, each with the SQL it is checked against."""

from importlib import import_module

AREAS = ("quality", "frames", "catalog", "validation", "relations", "annotations", "drift", "geometry", "matching",
         "images", "storage", "streams", "sliced")


def load_all() -> None:
    """Register the queries of every area."""
    for area in AREAS:
        import_module(f"{__name__}.{area}")
