"""Tables, scans, sinks and connectors."""
