"""Column -> Column helpers."""

from tessera.functions import geohash, scalars, versions  # noqa: F401
