"""Sinks: topic-routed files or Kafka, archives, keyed versioned tables."""
