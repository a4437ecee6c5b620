"""Connected components, as the whole library has them."""

from linkloom.graph import components

__all__ = ["components"]
