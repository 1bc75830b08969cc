"""shipcast: marketplace delivery analytics expressed as Spark DataFrame / SQL / ML jobs."""

__version__ = "0.1.0"
