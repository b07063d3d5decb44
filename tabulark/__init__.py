"""Tabular analytics and data movement on Spark."""

VERSION = __version__ = "0.2.0"
