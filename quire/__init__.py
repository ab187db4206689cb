"""quire: bibliographic metadata analytics as Spark DataFrame and SQL operators."""

__version__ = "0.1.0"
