"""Sky catalogs on Spark: scan, calibrate, partition, nest, match, check and correct."""

__version__ = "0.1.0"
