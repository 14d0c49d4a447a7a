"""Tiled-image anomaly analytics expressed as composable Spark DataFrame operators."""
