from __future__ import annotations

import gzip
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tessera.functions import casts
from tessera.operators.keep import last_writer_wins
from tessera.plans import silver
from tessera.plans.build import build_layers, read_sources
from tessera.sources import landing, lineage, readers, schemas, sinks
from tessera.sources.index_store import IndexStore
from tessera.streaming.incremental import land_new_files


def write_json(folder, name, value):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(value, indent=2))


def listing_csv(path, records):
    header = ",".join(schemas.LISTING_COLUMNS + ["extra"])
    lines = [",".join(r.get(c, "") for c in schemas.LISTING_COLUMNS) + ",x" for r in records]
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write("\n".join([header, *lines]) + "\n")


def test_listings_with_breaks_quotes_and_bad_numbers(spark, tmp_path):
    base = {"id": "1", "host_id": "7", "host_name": '"Ann ""A""\nof X"', "accommodates": "3.0", "host_response_rate": "N/A"}
    path = tmp_path / "listings.csv.gz"
    listing_csv(
        path,
        [
            {**base, "last_review": "2024-01-01", "bathrooms_text": "Half-bath", "beds": ""},
            {**base, "last_review": "2025-01-01", "bathrooms_text": "1.5 baths", "instant_bookable": "t"},
            {**base, "id": "2", "host_id": ""},
            {**base, "id": "x"},
        ],
    )
    raw = readers.read_listings(spark, str(path))
    assert raw.count() == 4 and all(t == "string" for _, t in raw.dtypes)
    got = silver.clean_listings(raw).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.host_name, row.accommodates, row.bathrooms) == ('Ann "A"\nof X', 3, 1.5)
    assert row.host_response_rate is None and row.instant_bookable is True and row.host_is_superhost is None
    assert len(got[0]) == 33


def test_reviews_bad_dates_and_repeats(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text("listing_id,date\n1,2024-01-01\n1,2024-01-01\n1,2024-13-01\nx,2024-01-01\n2,\n")
    got = silver.clean_reviews(readers.read_reviews(spark, str(tmp_path / "reviews.csv")))
    assert [(r[0], str(r[1])) for r in got.collect()] == [(1, "2024-01-01")]


def test_review_texts(spark, tmp_path):
    with gzip.open(tmp_path / "t.csv.gz", "wt", encoding="utf-8") as f:
        f.write('listing_id,id,date,comments\n1,9,2024-01-01,"  two\nlines "\nabc,9,2024-01-01,skipped\n')
    got = readers.read_review_texts(spark, str(tmp_path / "t.csv.gz"))
    assert rows(got) == [(1, "2024-01-01", "two\nlines")]


def test_weather_envelope(spark, tmp_path):
    daily = {
        "time": ["2024-01-01", "2024-01-03", "bad"],
        "temperature_2m_max": [1, 2.5, 3],
        "temperature_2m_min": [0, None, 0],
        "precipitation_sum": [0.0, 1, 0],
        "windspeed_10m_max": [5, 6, 7],
        "weathercode": [3, 61, None],
    }
    write_json(tmp_path, "w.json", {"meta": {"start_date": "2024-01-01"}, "daily": daily})
    got = silver.clean_weather(readers.read_weather(spark, str(tmp_path / "w.json")))
    assert [tuple(map(str, r)) for r in rows(got)] == [
        ("2024-01-01", "1.0", "0.0", "0.0", "5.0", "3"),
        ("2024-01-03", "2.5", "None", "1.0", "6.0", "61"),
    ]


def test_complaint_envelope(spark, tmp_path):
    good = {"unique_key": "1", "created_date": "2024-05-06T23:59:59.000", "borough": "Staten Island", "complaint_type": "Noise", "latitude": "40.5"}
    records = [good, {**good, "borough": "Unspecified"}, {**good, "created_date": "yesterday"}, {**good, "borough": None}, good]
    write_json(tmp_path, "n.json", {"meta": {}, "records": records})
    raw = readers.read_complaints(spark, str(tmp_path / "n.json"))
    assert raw.count() == 5
    got = silver.clean_complaints(raw).collect()
    assert len(got) == 2 and (got[0].borough, str(got[0].complaint_date), got[0].year, got[0].month) == ("Staten Island", "2024-05-06", 2024, 5)
    assert silver.clean_complaints(raw, unique=True).count() == 1


def place(pid, rating=None, lat=40.5, lng=-74.0, **more):
    return {"place_id": pid, "name": f"n{pid}", "geometry": {"location": {"lat": lat, "lng": lng}}, "types": ["bar"], **({"rating": rating} if rating is not None else {}), **more}


@pytest.fixture
def place_files(tmp_path):
    folder = tmp_path / "places"
    write_json(folder, "A.json", {"neighbourhood": "A", "results_by_type": {"bar": [place("1", 4), place("2", 4.5)], "lodging": []}, "results_deduped": [place("1", 4), place("2", 4.5)]})
    write_json(folder, "B.json", {"neighbourhood": "B", "results_by_type": {"bar": [place("2", lat=0, lng=0)]}, "results_deduped": [place("2", lat=0, lng=0), place("")]})
    write_json(folder, "lineage.json", {"source": "x"})
    return str(folder)


def test_places_by_type(spark, place_files):
    got = readers.place_rows(readers.read_place_files(spark, place_files))
    assert rows(got.select("neighbourhood", "place_type", "place_id", "rating")) == [
        ("A", "bar", "1", 4.0),
        ("A", "bar", "2", 4.5),
        ("B", "bar", "2", None),
    ]


def test_place_documents_last_file_wins(spark, place_files):
    boroughs = spark.createDataFrame([("A", "Queens")], "neighbourhood string, borough string")
    documents = readers.place_documents(readers.read_place_files(spark, place_files), boroughs)
    assert documents.count() == 3
    kept = {r.place_id: r for r in last_writer_wins(documents, "place_id", "file", "position").collect()}
    assert kept["1"].borough == "Queens" and kept["2"].borough == "Unknown" and kept["2"].neighbourhood == "B"
    assert kept["2"].geometry.asDict() == {"lon": 0.0, "lat": 0.0} and kept["1"].types == ["bar"]


def test_boundaries_of_both_kinds(spark, tmp_path):
    square = [[0, 0], [0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]
    features = [
        {"type": "Feature", "properties": {"neighbourhood": "A", "neighbourhood_group": "X"}, "geometry": {"type": "Polygon", "coordinates": [square]}},
        {"type": "Feature", "properties": {"neighbourhood": "B", "neighbourhood_group": "X"}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [[[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]]]}},
    ]
    write_json(tmp_path, "b.geojson", {"type": "FeatureCollection", "features": features})
    got = {r.neighbourhood: r for r in readers.boundary_documents(readers.read_boundaries(spark, str(tmp_path / "b.geojson"))).collect()}
    assert len(got["A"].shape) == 1 and len(got["A"].shape[0][0]) == 5
    assert got["A"].area_centroid["lon"] == pytest.approx(1.0) and got["A"].vertex_centroid["lon"] == pytest.approx(4 / 6)
    assert got["B"].area_centroid["lat"] == pytest.approx(6.0)


def test_newest_snapshot(spark, tmp_path):
    for day in ("2023-12-01", "2024-01-05"):
        folder = tmp_path / f"up_to_{day}"
        folder.mkdir()
        (folder / "reviews.csv").write_text("listing_id,date\n")
    files = readers.snapshot_files(spark, str(tmp_path), "reviews.csv")
    newest = readers.newest_snapshot(files, "path").collect()
    assert [r.snapshot for r in newest] == ["2024-01-05"]
    none = spark.createDataFrame([("/raw/other/x.csv",)], "path string")
    with pytest.raises(Exception, match="snapshot folder"):
        readers.newest_snapshot(none, "path").collect()


def test_articles(spark):
    pages = spark.createDataFrame(
        [("A", "<p>In Queens.</p><h2>x</h2>"), ("B", "<p>In Perth.</p>"), ("C", "<h2>x</h2><p>y</p>")], "name string, html string"
    )
    got = landing.articles_from_pages(pages, "html")
    assert rows(got.select("name", "status", "paragraph_count")) == [("A", "ok", 1), ("B", "wrong_location", 1), ("C", "error", 0)]


def test_links(spark):
    html = "<a href='/usa/ny/2024-05-01/data'>x</a> <A class=b HREF=\"/usa/ny/2023-01-01/d\">y</A><a name=q>z</a><a href='/usa/ny/2024-05-01/v'>x</a>"
    pages = spark.createDataFrame([(html,), (None,)], "html string")
    got = landing.discovered_links(pages, "html", r"/usa/ny/(\d{4}-\d{2}-\d{2})/", "day")
    assert [r.day for r in got.collect()] == ["2023-01-01", "2024-05-01"]


def test_landing_twice_and_after_a_new_file(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = spark.range(5).coalesce(1)
    first.write.parquet(source)
    runs = [land_new_files(spark, source, first.schema, target, checkpoint).count() for _ in range(2)]
    spark.range(5, 8).coalesce(1).write.mode("append").parquet(source)
    runs.append(land_new_files(spark, source, first.schema, target, checkpoint).count())
    assert runs == [5, 5, 8]


def test_lineage_latest_record_counts(spark):
    records = spark.createDataFrame(
        [("a", "error", 0, "2024-01-01 00:00:00"), ("a", "ok", 5, "2024-01-02 00:00:00"), ("b", "skipped", None, "2024-01-01 00:00:00")],
        "item string, status string, rows bigint, at string",
    ).withColumn("finished_at", F.to_timestamp("at"))
    assert rows(lineage.status_totals(records)) == [("ok", 1, 5), ("skipped", 1, 0)]


def test_coverage(spark):
    wanted = spark.sql("SELECT DATE'2024-01-01' AS start_date, DATE'2024-02-01' AS end_date")
    assert landing.coverage_changed(wanted, "2024-01-01", "2024-02-01").first().refetch is False
    assert landing.coverage_changed(wanted, None, "2024-02-01").first().refetch is True


def test_write_counts_and_index_keeps_one_per_id(spark, tmp_path):
    documents = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, v int")
    stored, n = sinks.write_index(documents, str(tmp_path / "index"))
    assert n == 2 and stored.count() == 2
    again, n = sinks.write_parquet(documents, str(tmp_path / "index"))
    assert n == 3 and again.count() == 3


def test_publish_and_reload(spark, tmp_path):
    df = spark.createDataFrame([(1, ["b", "a"])], "id int, kinds array<string>")
    df.write.parquet(str(tmp_path / "gold/t1"))
    assert sinks.reload_published(spark, str(tmp_path / "gold"), ["t1"], prefix="reloaded_") == {"t1": 1}
    assert sinks.publish(df.limit(0), "reloaded_t1") == 0
    assert spark.table("reloaded_t1").count() == 0
    assert sinks.arrays_as_json(df).first().kinds == '["b","a"]'
    spark.sql("DROP TABLE reloaded_t1")


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("bucketed_a", "bucketed_b"):
        df = spark.range(1000).select(F.col("id").alias("k"), F.lit(name).alias(name))
        assert sinks.publish(df, name, buckets=4, bucket_by=["k"]) == 1000
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")


def test_layers_from_raw_folders(spark, tmp_path):
    raw = tmp_path / "raw"
    for day, listing in (("2024-01-01", "9"), ("2024-06-01", "1")):
        folder = raw / "snapshots" / f"up_to_{day}"
        folder.mkdir(parents=True)
        base = {"id": listing, "host_id": "7", "neighbourhood_cleansed": "A", "neighbourhood_group_cleansed": "Queens"}
        listing_csv(folder / "listings.csv.gz", [base, {**base, "id": "2"}])
        (folder / "reviews.csv").write_text(f"listing_id,date\n{listing},2024-05-06\n2,2024-05-07\n3,2024-05-07\n")
    daily = {n: [1.0, 2.0] for n in ("temperature_2m_max", "temperature_2m_min", "precipitation_sum", "windspeed_10m_max", "weathercode")}
    write_json(raw / "weather", "w.json", {"daily": {"time": ["2024-04-26", "2024-05-06"], **daily}})
    complaint = {"unique_key": "1", "created_date": "2024-05-06T00:00:00.000", "borough": "QUEENS", "complaint_type": "Noise"}
    write_json(raw / "noise", "n.json", {"records": [complaint, complaint]})
    write_json(raw / "places", "A.json", {"neighbourhood": "A", "results_by_type": {"bar": [place("1", 4)]}})
    tables, record = build_layers(spark, read_sources(spark, str(raw)), str(tmp_path / "out"))
    counts = {r.item: r.rows for r in record.collect()}
    assert (counts["bronze/listings"], counts["silver/reviews"], counts["gold/fact_review"]) == (2, 3, 2)
    assert rows(tables["fact_review"].select("review_id", "complaint_count")) == [("1-20240506", 2), ("2-20240507", 2)]
    assert rows(tables["fact_review_weather"].select("review_id", "days_before_review")) == [("1-20240506", 10), ("2-20240507", 1)]
    assert tables["dim_neighbourhood"].first().poi_bar == 1
    assert rows(lineage.status_totals(record))[0][:2] == ("ok", len(counts))


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-05-06T23:59:59.000", "2024-05-06"),
        ("2024-05-06T24:59:59.000", None),
        ("2024-02-30T00:00:00.000", None),
        ("2024-05-06", None),
        ("2024-05-06T23:59:59", None),
        ("2024-05-06T23:59:59.000Z", None),
        (None, None),
    ],
)
def test_complaint_times(spark, value, expected):
    got = spark.createDataFrame([(value,)], "v string").select(casts.iso_millis_to_date("v").cast("string")).first()[0]
    assert got == expected


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    (one / "a.csv").write_text("date,listing_id\n2020-01-01,5\n")
    assert [tuple(r) for r in readers.read_reviews(spark, str(one)).collect()] == [("5", "2020-01-01")]
    (two / "a.csv").write_text("listing_id,date\n5,2020-01-01\n")
    (two / "b.csv").write_text("date,listing_id\n2020-01-02,6\n")
    with pytest.raises(Exception, match="header"):
        readers.read_reviews(spark, str(two)).collect()


def test_lineage_lasts_over_runs(spark, tmp_path):
    path = str(tmp_path / "lineage")
    def run(rows_in):
        lineage.append(spark.createDataFrame(rows_in, "item string, status string, rows bigint, day string").selectExpr("item", "status", "rows", "timestamp(day) AS finished_at"), path)

    run([("a", "error", 0, "2024-01-01"), ("b", "ok", 3, "2024-01-01")])
    run([("a", "ok", 5, "2024-01-02"), ("c", "error", 0, "2024-01-02")])
    assert {(r.item, r.status, r.rows) for r in lineage.stored(spark, path).collect()} == {("a", "ok", 5), ("b", "ok", 3), ("c", "error", 0)}
    items = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "name string")
    assert sorted(r.name for r in lineage.due(items, "name", path).collect()) == ["c", "d"]


def test_stored_index_is_upserted(spark, tmp_path):
    root = str(tmp_path / "index")
    def rows_of(*entries):
        return spark.createDataFrame(list(entries), "id string, version int, x int")

    store = IndexStore(spark, root, buckets=2)
    _, n = store.upsert(rows_of(("a", 1, 1), ("b", 1, 1), ("a", 0, 9)), "version")
    assert n == 2
    _, n = store.upsert(rows_of(("b", 2, 5), ("c", 2, 5), ("a", 0, 7)), "version")
    assert n == 2 and {tuple(r) for r in store.read().collect()} == {("a", 1, 1), ("b", 2, 5), ("c", 2, 5)}


def test_document_load_counts_upserts_and_stored(spark, tmp_path, data):
    from tessera.plans import documents
    from tessera.workload import roles

    files = roles.place_envelopes(spark, data).withColumn("file", F.lit("one"))
    twice = files.unionByName(files.withColumn("file", F.lit("two")))
    stored, counts = documents.load_places(twice, roles.boroughs(spark, data), str(tmp_path / "places"))
    n = roles.places(spark, data).count()
    assert counts == {"upserts": 2 * n, "stored": n} and stored.count() == n
    shapes = roles.shapes(spark, data).select("neighbourhood", "borough", "shape")
    broken = shapes.limit(1).withColumn("shape", F.lit(None).cast(shapes.schema["shape"].dataType))
    _, counts = documents.load_boundaries(shapes.unionByName(broken), str(tmp_path / "areas"))
    assert counts == {"stored": 25, "skipped": 1}


def test_sorted_tables_hold_ranges(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id % 1000 AS day", "id")
    table, n = sinks.write_parquet(df, str(tmp_path / "t"), ("day", "id"))
    assert n == 20_000
    spans = table.groupBy(F.col("_metadata.file_name")).agg(F.min("day").alias("a"), F.max("day").alias("b")).orderBy("a").collect()
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))
