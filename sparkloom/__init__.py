"""A Spark-native engine for catalogue data, pages and text corpora."""
