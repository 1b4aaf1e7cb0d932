"""vitrine: catalogue and event analytics expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
