"""Spark-native trip and weather analytics: event envelopes to features and marts."""
