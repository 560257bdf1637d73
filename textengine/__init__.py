"""Spark-native cleaning, auditing and measuring of large text corpora."""
