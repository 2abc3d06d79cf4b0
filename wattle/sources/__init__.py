"""Readers (driver tables, raw source files, derived stand-ins) and sinks."""
