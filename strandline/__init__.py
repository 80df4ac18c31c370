"""strandline: a PySpark-native engine for ordered observation sequences."""
