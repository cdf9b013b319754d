"""Docketry: document registries and their enrichment as Spark DataFrame operators."""
