"""envflow: a PySpark-native analytics engine for environmental observation data."""
