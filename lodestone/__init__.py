"""lodestone: a PySpark-native engine for bitemporal property graphs and evidence retrieval."""
