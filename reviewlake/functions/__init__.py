"""Scalar column rules (text, vectors, misc)."""

from reviewlake.functions import misc, text, vectors  # noqa: F401
