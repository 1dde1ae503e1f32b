"""aqgrid: urban air-quality analytics as Spark DataFrame operators."""
