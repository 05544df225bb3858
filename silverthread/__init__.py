"""Member-360 data engine expressed as PySpark DataFrame operators."""

__version__ = "0.1.0"
