"""Delay analytics on transport legs and related tables, as Spark jobs."""

__version__ = "0.1.0"
