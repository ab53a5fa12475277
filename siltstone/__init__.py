"""siltstone: a Spark-native census of web platforms."""
