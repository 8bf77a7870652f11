"""runloom: a PySpark-native engine for agent-run evidence and training data."""

__version__ = "0.1.0"
