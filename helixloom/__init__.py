"""A Spark-native engine for chimeric-transcript evidence."""
