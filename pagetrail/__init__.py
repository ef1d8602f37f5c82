"""Web-corpus, web-graph and request-log analytics expressed as Spark jobs."""

__version__ = "0.1.0"
