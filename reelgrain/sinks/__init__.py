"""Writers: artifacts, objects, published models."""
