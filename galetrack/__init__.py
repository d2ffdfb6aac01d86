"""A PySpark-native analytics engine for tropical-cyclone best-track data."""
