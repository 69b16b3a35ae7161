"""Readers (test tables, fixture views, raw collections with declared schemas) and sinks."""
