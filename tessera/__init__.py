"""tessera: a catalog-feed analytics engine built from Spark DataFrame operators."""

__version__ = "0.1.0"
