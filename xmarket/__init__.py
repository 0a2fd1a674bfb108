"""xmarket: a PySpark-native engine for matching equivalent contracts across two venues."""
