"""Sketch, search, graph and audit operators over sequence and document collections, as Spark jobs."""

__version__ = "0.1.0"
