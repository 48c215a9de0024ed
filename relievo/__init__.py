"""Terrain compositing and lidar validation as Spark DataFrame operators."""
