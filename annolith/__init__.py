"""annolith: a PySpark-native analytics engine for episode annotation data."""
