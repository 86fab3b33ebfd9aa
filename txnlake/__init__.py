"""A PySpark-native engine for personal transaction data: cleaning, identity, layers, scores, audit and reconciliation."""
