"""Feed schemas, scans, sinks, and the adapters that shape the given tables into feeds."""
