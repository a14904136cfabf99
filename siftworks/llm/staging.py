"""Intermediate tables of this subpackage, staged as the rest of the library stages its own."""

from ..staging import drop_staged, shared_dir, stage

__all__ = ["drop_staged", "shared_dir", "stage"]
