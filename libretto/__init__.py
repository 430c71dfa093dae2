"""A PySpark-native engine that turns long documents into auditable, speech-ready text."""
