"""Sinks: topic messages, dead letters, Avro export and the outbound-request outbox."""
