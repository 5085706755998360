"""The document load: places and boundaries into stored tables, with what was written and what is held."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tessera.operators.keep import last_writer_wins
from tessera.sources import readers
from tessera.sources.sinks import write_parquet


def load_places(envelopes: DataFrame, boroughs: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Store one document per place, the last file's, and count upserts and stored places."""
    found = readers.place_documents(envelopes, boroughs)
    upserts = found.count()
    stored, n = write_parquet(last_writer_wins(found, "place_id", "file", "position").drop("file", "position"), path)
    return stored, {"upserts": upserts, "stored": n}


def load_boundaries(boundaries: DataFrame, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Store a document per boundary that has a shape, and count those left out."""
    documents = readers.boundary_documents(boundaries)
    usable = documents.filter("shape IS NOT NULL AND size(shape) > 0")
    stored, n = write_parquet(usable, path)
    return stored, {"stored": n, "skipped": boundaries.count() - n}
