"""palimpsest: a PySpark engine for collections of numbered publications."""

__version__ = "0.1.0"
