"""Readers and writers."""

from tessera.sources import files, sinks, tables  # noqa: F401
