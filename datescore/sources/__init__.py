"""Sources and sinks: events-derived features, feature table, text files, result table, models."""
