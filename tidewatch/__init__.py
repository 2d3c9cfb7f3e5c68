"""PySpark-native anomaly analytics over daily series and transfer graphs."""
