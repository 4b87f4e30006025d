"""folioscope: a PySpark-native engine for document corpora."""
