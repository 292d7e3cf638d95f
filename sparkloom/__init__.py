"""Sparkloom: a Spark-native engine for building and curating text datasets."""
