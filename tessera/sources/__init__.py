"""Schemas, readers, landing logic, lineage records and sinks."""
