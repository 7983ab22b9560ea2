"""Sources: request logs, CSV uploads, topics and backup logs as DataFrames."""
