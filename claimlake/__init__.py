"""claimlake: document-to-knowledge pipelines as typed DataFrame operators on Spark."""

__version__ = "0.1.0"
