"""ferrule: a PySpark-native engine that turns documents, layout blocks and extracted records into strict tables."""
