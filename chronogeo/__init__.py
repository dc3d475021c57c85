"""chronogeo: historical-map data work expressed as Spark DataFrame jobs.

Sub-packages
------------
functions   column expressions (years, text, ids, geometry)
operators   DataFrame -> DataFrame building blocks
sources     readers, writers and versioned snapshots
plans       whole jobs composed from the operators
streaming   change propagation with Structured Streaming
"""

__version__ = "0.1.0"
