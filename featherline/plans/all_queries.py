"""Importing this registers every query."""

from featherline.plans import awkward, boosting, encoding, models, quality, streams  # noqa: F401
