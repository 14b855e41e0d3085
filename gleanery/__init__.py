"""A Spark-native engine for curating media and text collections."""
