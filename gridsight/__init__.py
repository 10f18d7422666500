"""gridsight: a PySpark-native engine for gridded detection analytics."""
