"""Spark-native operators for curating speech corpora and evaluating the models trained on them."""
