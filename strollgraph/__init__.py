"""Spark-native screening of access land for walking connections to the road network."""
