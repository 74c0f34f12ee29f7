"""A Spark-native catalogue build-and-search engine."""
