"""meridian: a PySpark-native engine for time-stamped, located, vectorised and textual event tables."""
