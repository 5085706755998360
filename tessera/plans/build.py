"""The layered build: raw sources to cleaned tables to the star schema, with a record of it."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans import gold, silver
from tessera.sources import readers
from tessera.sources.lineage import RECORD
from tessera.sources.sinks import write_parquet

SOURCES = ("listings", "reviews", "weather", "noise_complaints", "places")


@dataclass
class Build:
    """Writes each table of a layer once and goes on from what was written.

    Later stages therefore never recompute earlier ones, ids in the bridge are those of
    the written fact, small dimensions are planned by the size of their files, and row
    counts come from the writes.
    """

    spark: SparkSession
    out: str
    written: list[tuple[str, int]] = field(default_factory=list)

    def write(self, layer: str, name: str, df: DataFrame, sort_by: tuple[str, ...] = ()) -> DataFrame:
        table, n = write_parquet(df, f"{self.out}/{layer}/{name}", sort_by)
        self.written.append((f"{layer}/{name}", n))
        return table

    def write_all(self, layer: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Tables that do not depend on each other, written at the same time."""
        with ThreadPoolExecutor(len(tables)) as pool:
            jobs = {
                name: pool.submit(inheritable_thread_target(self.spark)(self.write), layer, name, df)
                for name, df in tables.items()
            }
            return {name: job.result() for name, job in jobs.items()}

    def record(self) -> DataFrame:
        """One record per written table, in the form of the lineage table."""
        rows = self.spark.createDataFrame(sorted(self.written), "item string, rows bigint")
        made = rows.select("item", F.lit("ok").alias("status"), "rows", F.current_timestamp().alias("finished_at"))
        return made.to(self.spark.createDataFrame([], RECORD).schema)


def read_sources(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """The five raw sources below ``raw``; listings and reviews of the newest snapshot.

    Layout: snapshots/up_to_<date>/{listings.csv.gz,reviews.csv}, weather/*.json,
    noise/*.json, places/*.json.
    """
    files = readers.snapshot_files(spark, f"{raw}/snapshots", "reviews.csv")
    newest = readers.newest_snapshot(files, "path").select("snapshot").first()["snapshot"]
    snapshot = f"{raw}/snapshots/up_to_{newest}"
    return {
        "listings": readers.read_listings(spark, f"{snapshot}/listings.csv.gz"),
        "reviews": readers.read_reviews(spark, f"{snapshot}/reviews.csv"),
        "weather": readers.read_weather(spark, f"{raw}/weather"),
        "noise_complaints": readers.read_complaints(spark, f"{raw}/noise"),
        "places": readers.place_rows(readers.read_place_files(spark, f"{raw}/places")),
    }


def build_layers(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out: str,
    boroughs: dict[str, str] = silver.BOROUGHS,
    place_types: list[str] = gold.PLACE_TYPES,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Bronze, silver and gold Parquet below ``out``; returns the gold tables and the record.

    ``raw`` holds a frame per name in SOURCES.
    """
    build = Build(spark, out)
    bronze = build.write_all("bronze", {name: raw[name] for name in SOURCES})
    clean = {
        "listings": silver.clean_listings,
        "reviews": silver.clean_reviews,
        "weather": silver.clean_weather,
        "noise_complaints": lambda df: silver.clean_complaints(df, boroughs),
        "places": silver.clean_places,
    }
    tidy = build.write_all("silver", {name: make(bronze[name]) for name, make in clean.items()})
    tables = build.write_all(
        "gold",
        {
            "dim_date": gold.dim_date(tidy["reviews"]),
            "dim_neighbourhood": gold.dim_neighbourhood(tidy["listings"], tidy["places"], place_types),
            "dim_host": gold.dim_host(tidy["listings"]),
            "dim_listing": gold.dim_listing(tidy["listings"]),
            "noise_borough_month": gold.noise_borough_month(tidy["noise_complaints"]),
        },
    )
    # sorted by day, so that questions about a period skip files and row groups by their statistics
    fact = gold.fact_review(tidy["reviews"], tidy["listings"], tables["noise_borough_month"])
    tables["fact_review"] = build.write("gold", "fact_review", fact, ("review_date", "listing_id"))
    bridge = gold.fact_review_weather(tables["fact_review"], tidy["weather"])
    tables["fact_review_weather"] = build.write("gold", "fact_review_weather", bridge)
    return {name: tables[name] for name in gold.LOAD_ORDER}, build.record()
