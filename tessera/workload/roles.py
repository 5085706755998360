"""The driver's tables in the roles of the raw sources and of the star schema.

Only arithmetic on columns and joins with the 5-row and 25-row tables are used, and
every role covers its whole table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.scoring import CONTEXT_TOOL, GEODATA_TOOL, REVIEW_TOOL, ROUTES, WAREHOUSE_TOOL, question_answer_pairs
from tessera.plans import gold, silver
from tessera.session import scratch_path

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PLACE_TYPES = ["ECONOMY", "STANDARD", "PROMO", "MEDIUM", "LARGE", "SMALL"]
WEST, SOUTH, CELL_LON, CELL_LAT = -74.25, 40.5, 0.11, 0.08

# Words of which a page must hold one to be an article of the area.
ARTICLE_WORDS = ("the", "que")

_WRITTEN: dict[tuple[str, str, str, int], tuple[str, StructType]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def boroughs(spark: SparkSession, sf: str) -> DataFrame:
    """(n_nationkey, neighbourhood, borough): 25 rows."""
    region = table(spark, sf, "region")
    nation = table(spark, sf, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("neighbourhood"), F.col("r_name").alias("borough")
    )


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as an all-text listing scan with the usual blemishes of one."""
    located = table(spark, sf, "customer").join(
        boroughs(spark, sf), F.col("c_nationkey") == F.col("n_nationkey")
    )
    rows = located.withColumn("k", F.col("c_custkey")).withColumn("h", F.expr("c_custkey div 15"))
    return rows.selectExpr(
        "cast(k as string) AS id",
        "cast(h as string) AS host_id",
        "concat('Host \"', h, '\"\\n of ', neighbourhood) AS host_name",
        "cast(date_add(DATE'2008-01-01', cast(h % 4000 AS int)) AS string) AS host_since",
        "CASE WHEN h % 11 = 5 THEN NULL WHEN h % 3 = 0 THEN 't' ELSE 'f' END AS host_is_superhost",
        "element_at(array('within an hour', 'within a few hours', 'within a day', 'N/A'), cast(h % 4 AS int) + 1) AS host_response_time",
        "CASE WHEN h % 5 = 0 THEN 'N/A' ELSE concat(h % 101, '%') END AS host_response_rate",
        "CASE WHEN h % 7 = 0 THEN NULL ELSE concat(h % 89, '.5%') END AS host_acceptance_rate",
        "CASE WHEN h % 3 = 0 THEN concat(h % 40, '.0') ELSE cast(h % 40 AS string) END AS host_total_listings_count",
        "CASE WHEN h % 4 = 1 THEN 'f' ELSE 't' END AS host_identity_verified",
        "neighbourhood AS neighbourhood_cleansed",
        "borough AS neighbourhood_group_cleansed",
        "concat('40.', lpad(cast(k * 7 % 10000 AS string), 4, '0')) AS latitude",
        "concat('-73.', lpad(cast(k * 13 % 10000 AS string), 4, '0')) AS longitude",
        "c_mktsegment AS room_type",
        "concat('Entire ', lower(c_mktsegment)) AS property_type",
        "cast(k % 16 + 1 AS string) AS accommodates",
        "CASE WHEN k % 9 = 0 THEN '' WHEN k % 2 = 0 THEN concat(k % 6, '.0') ELSE cast(k % 6 AS string) END AS bedrooms",
        "CASE WHEN k % 13 = 0 THEN NULL ELSE cast(k % 8 AS string) END AS beds",
        "CASE k % 4 WHEN 0 THEN concat(k % 5, '.5 baths') WHEN 1 THEN concat(k % 5, ' shared baths') WHEN 2 THEN 'Half-bath' END AS bathrooms_text",
        "cast(k % 30 + 1 AS string) AS minimum_nights",
        "cast(k * 37 % 366 AS string) AS estimated_occupancy_l365d",
        "CASE WHEN k % 3 = 0 THEN NULL WHEN k % 2 = 0 THEN 't' ELSE 'f' END AS instant_bookable",
        "cast(c_acctbal AS string) AS review_scores_rating",
        "concat(k % 5, '.', lpad(cast(k % 100 AS string), 2, '0')) AS review_scores_accuracy",
        "concat(k * 3 % 5, '.', lpad(cast(k * 3 % 100 AS string), 2, '0')) AS review_scores_cleanliness",
        "CASE WHEN k % 17 = 0 THEN '' ELSE concat(k % 5, '.5') END AS review_scores_checkin",
        "concat(k * 2 % 5, '.25') AS review_scores_communication",
        "cast(k % 6 AS string) AS review_scores_location",
        "concat(k * 7 % 5, '.75') AS review_scores_value",
        "CASE WHEN k % 19 = 0 THEN 'unknown' ELSE cast(date_add(DATE'2010-01-01', cast(k % 2000 AS int)) AS string) END AS first_review",
        "cast(date_add(DATE'2016-01-01', cast(k % 2000 AS int)) AS string) AS last_review",
        "cast(k % 300 AS string) AS number_of_reviews",
    )


def raw_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("listing_id"), F.col("o_orderdate").cast("date").cast("string").alias("date")
    )


def raw_weather(spark: SparkSession, sf: str) -> DataFrame:
    """One row per ship date."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("weather_date"))
        .agg(
            F.max("l_quantity").alias("temperature_max"),
            F.min("l_quantity").alias("temperature_min"),
            F.max("l_discount").alias("precipitation_sum"),
            F.max("l_tax").alias("windspeed_max"),
            (F.count(F.lit(1)) % 100).cast("double").alias("weathercode"),
        )
    )


def raw_complaints(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item as a complaint; the seventh lines have no usable borough."""
    region = table(spark, sf, "region").select("r_regionkey", F.initcap("r_name").alias("r_title"))
    rows = table(spark, sf, "lineitem").join(region, F.expr("l_suppkey % 5") == F.col("r_regionkey"))
    return rows.selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS unique_key",
        "concat(cast(l_shipdate AS date), 'T', substring(cast(l_shipdate AS string), 12, 8), '.000') AS created_date",
        "concat('Noise - ', l_returnflag) AS complaint_type",
        "l_linestatus AS descriptor",
        "cast(NULL AS string) AS incident_zip",
        "CASE WHEN l_linenumber = 7 THEN 'Unspecified' ELSE r_title END AS borough",
        "cast(NULL AS string) AS community_board",
        "concat('40.', lpad(cast(l_partkey % 10000 AS string), 4, '0')) AS latitude",
        "concat('-73.', lpad(cast(l_partkey % 9973 AS string), 4, '0')) AS longitude",
        "'Closed' AS status",
        "cast(NULL AS string) AS resolution_description",
    )


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as stored places, one row each."""
    rows = table(spark, sf, "part").withColumn("_nation", F.expr("cast(p_partkey % 7 * p_size % 25 AS int)"))
    return rows.join(boroughs(spark, sf), F.col("_nation") == F.col("n_nationkey")).selectExpr(
        "concat('place-', p_partkey) AS place_id",
        "p_name AS name",
        "neighbourhood",
        "borough",
        "p_type AS place_type",
        "array(p_type, 'establishment') AS types",
        "CASE WHEN p_size = 50 THEN NULL ELSE (p_size % 41 + 10) / 10.0D END AS rating",
        "p_partkey * 3 AS user_ratings_total",
        "concat(p_brand, ' Street') AS vicinity",
        "cast(p_size % 5 AS bigint) AS price_level",
        "-74.25D + cast(p_partkey * 7919 % 10000 AS double) * 0.000055D AS lon",
        "40.5D + cast(p_partkey * 104729 % 10000 AS double) * 0.000040D AS lat",
        "p_partkey",
        "n_nationkey",
    )


def place_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Search results by file: each place is found from its own and from a second neighbourhood."""
    found = places(spark, sf)
    areas = boroughs(spark, sf).select(F.col("n_nationkey").alias("_n"), F.col("neighbourhood").alias("file"))
    turns = F.explode(
        F.array(
            F.struct(F.col("n_nationkey").alias("n"), F.lit(0).alias("shift")),
            F.struct(F.expr("cast((p_partkey * 7 + 3) % 25 AS int)").alias("n"), F.lit(1).alias("shift")),
        )
    )
    return (
        found.select("*", turns.alias("_turn"))
        .join(areas, F.col("_turn.n") == F.col("_n"))
        .selectExpr(
            "file",
            "p_partkey * 2 + _turn.shift AS position",
            "place_id",
            "concat(name, ' #', _turn.shift) AS name",
            "place_type",
            "rating",
            "lat",
            "lon AS lng",
        )
    )


def place_envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Search results as nested files: a page of places of one neighbourhood, by type and all together."""
    place = F.struct(
        "place_id",
        "name",
        "rating",
        "user_ratings_total",
        "types",
        "vicinity",
        "price_level",
        F.lit("OPERATIONAL").alias("business_status"),
        F.struct(F.struct("lat", F.col("lon").alias("lng")).alias("location")).alias("geometry"),
    )
    found = places(spark, sf).withColumns({"p": place, "page": F.expr("p_partkey div 200")})
    typed = found.groupBy("neighbourhood", "page", "place_type").agg(F.collect_list("p").alias("of_type"))
    return typed.groupBy("neighbourhood", "page").agg(
        F.map_from_entries(F.collect_list(F.struct("place_type", "of_type"))).alias("results_by_type"),
        F.flatten(F.collect_list("of_type")).alias("results_deduped"),
    ).drop("page")


def shapes(spark: SparkSession, sf: str) -> DataFrame:
    """A grid cell per nation with a square hole, and an island inside the hole."""
    west = F.lit(WEST) + (F.col("n_nationkey") % 5).cast("double") * F.lit(CELL_LON)
    south = F.lit(SOUTH) + F.floor(F.col("n_nationkey") / 5).cast("double") * F.lit(CELL_LAT)
    corners = boroughs(spark, sf).withColumns({"x": west, "y": south})

    def square(inset: float) -> Column:
        x0, x1 = F.col("x") + inset * CELL_LON, F.col("x") + (1 - inset) * CELL_LON
        y0, y1 = F.col("y") + inset * CELL_LAT, F.col("y") + (1 - inset) * CELL_LAT
        ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return F.array(*[F.struct(a.alias("lon"), b.alias("lat")) for a, b in ring])

    shape = F.array(F.array(square(0.0), square(0.25)), F.array(square(0.375)))
    return corners.select("n_nationkey", "neighbourhood", "borough", shape.alias("shape"))


def raw_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as review texts of the listing that their source numbers."""
    return table(spark, sf, "documents").selectExpr(
        "substring(source, 4) AS listing_id",
        "cast(date_add(DATE'2020-01-01', cast(doc_id % 1461 AS int)) AS string) AS date",
        "text AS comments",
        "doc_id AS review_key",
    )


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as articles: the first ones about the neighbourhoods of the listings, the others about their own."""
    region = table(spark, sf, "region")
    rows = table(spark, sf, "pages").join(region, F.expr("cast(page_id % 5 AS int)") == F.col("r_regionkey"))
    named = rows.join(table(spark, sf, "nation"), F.col("page_id") == F.col("n_nationkey"), "left")
    return named.selectExpr(
        "coalesce(n_name, concat('PAGE_', page_id)) AS neighbourhood",
        "CASE WHEN page_id % 3 = 0 THEN NULL ELSE r_name END AS borough",
        "url AS wikipedia_url",
        "html",
    )


def page_boroughs(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup that knows some of the pages only."""
    named = table(spark, sf, "labels").join(table(spark, sf, "nation"), F.col("doc_id") == F.col("n_nationkey"), "left")
    return named.selectExpr("coalesce(n_name, concat('PAGE_', doc_id)) AS neighbourhood", "concat('LABEL_', quality) AS borough")


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """User turns with the reply that follows as recorded question-and-answer runs."""
    def tools(*names: str) -> str:
        return "array(" + ", ".join(f"'{n}'" for n in names) + ")"

    expected = f"""CASE conv_id % 5 WHEN 0 THEN {tools(WAREHOUSE_TOOL)} WHEN 1 THEN {tools(GEODATA_TOOL)}
        WHEN 2 THEN {tools(REVIEW_TOOL, CONTEXT_TOOL)} WHEN 3 THEN {tools(GEODATA_TOOL, WAREHOUSE_TOOL)}
        ELSE {tools(WAREHOUSE_TOOL, REVIEW_TOOL)} END"""
    called = f"""CASE (conv_id + turn) % 7 WHEN 0 THEN {tools(WAREHOUSE_TOOL)}
        WHEN 1 THEN {tools(GEODATA_TOOL, GEODATA_TOOL)} WHEN 2 THEN {tools(REVIEW_TOOL, CONTEXT_TOOL)}
        WHEN 3 THEN {tools(GEODATA_TOOL, WAREHOUSE_TOOL)} WHEN 4 THEN {tools(WAREHOUSE_TOOL, CONTEXT_TOOL)}
        WHEN 5 THEN {tools(GEODATA_TOOL, REVIEW_TOOL)} ELSE cast(array() AS array<string>) END"""
    routes = tools(*ROUTES)
    return question_answer_pairs(table(spark, sf, "conversations")).selectExpr(
        "conv_id * 100 + turn AS id",
        "question",
        "cast(conv_id % 4 + 1 AS int) AS difficulty",
        f"element_at({routes}, cast(conv_id % 5 AS int) + 1) AS expected_route",
        f"{expected} AS expected_tools",
        f"{called} AS tools_called",
        f"CASE WHEN conv_id % 4 = 0 THEN {tools(GEODATA_TOOL)} ELSE cast(array() AS array<string>) END AS failed_tools",
        "concat('rows ', conv_id * 1234 + turn, ' value ', conv_id * 10, '.50') AS context",
        "CASE WHEN answer IS NULL THEN '' ELSE concat(answer, ' Total ', format_number(conv_id * 1234 + turn, 0), ' of ', conv_id * 10, '.5', CASE WHEN conv_id % 3 = 0 THEN ' and 7' ELSE '' END) END AS answer",
        "CASE WHEN conv_id % 10 = 9 THEN NULL ELSE cast(conv_id % 11 AS double) / 10.0D END AS judge_score",
        "cast(conv_id * 37 % 100 AS double) / 10.0D AS elapsed_seconds",
    )


def tool_results(spark: SparkSession, sf: str) -> DataFrame:
    """Every turn of a conversation as one returned row of one of four tool calls."""
    names = ", ".join(f"'{t}'" for t in (WAREHOUSE_TOOL, GEODATA_TOOL, REVIEW_TOOL, CONTEXT_TOOL))
    return table(spark, sf, "conversations").selectExpr(
        "conv_id AS id",
        "turn AS position",
        "turn % 4 AS call",
        f"element_at(array({names}), cast(turn % 4 AS int) + 1) AS tool",
        "turn div 4 + 1 AS rank",
        "text AS result",
        "CASE WHEN conv_id % 7 = 0 AND turn % 4 = 1 THEN 'timeout' END AS error",
        "role AS label",
        "conv_id * 1.23456D + turn AS amount",
        "text AS document",
    )


def run_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as run records: each user is an item, each event one run over it."""
    return table(spark, sf, "events").selectExpr(
        "concat('item-', user_id) AS item",
        "event_type AS status",
        "cast(floor(value) AS bigint) AS rows",
        "ts AS finished_at",
    )


def listings(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_listings(raw_listings(spark, sf))


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_reviews(raw_reviews(spark, sf))


def weather(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_weather(raw_weather(spark, sf))


def complaints(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_complaints(raw_complaints(spark, sf), {r: r for r in REGIONS})


def clean_places(spark: SparkSession, sf: str) -> DataFrame:
    return silver.clean_places(places(spark, sf).withColumnRenamed("lon", "lng"))


def input_state(spark: SparkSession, sf: str) -> int:
    """Changes when a file directly below the inputs' folder does: newest time and sum of sizes."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return hash(tuple((f.getPath().getName(), f.getModificationTime(), f.getLen()) for f in listed))


def once(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A table written once per application and state of the inputs, then read back: published, in the shared folder."""
    key = (spark.sparkContext.applicationId, sf, name, input_state(spark, sf))
    if key not in _WRITTEN:
        df = build()
        path = scratch_path(spark, name)
        df.write.parquet(path)
        _WRITTEN[key] = (path, df.schema)
    path, schema = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


class Star(Mapping):
    """The star schema over the roles, each table made when it is first asked for.

    ``published`` tables, and the cleaned ones they come from, are written once and read
    back, as a warehouse is loaded once and then queried; reads are pruned to the columns
    a question needs. Otherwise only the four small tables (days, neighbourhoods, monthly
    complaints, daily weather) are written, so that joins with them are planned by their
    file size, and the rest are plans from the raw roles. The bridge always stays a plan.
    """

    CLEAN = ("listings", "reviews", "places")
    SMALL = ("dim_date", "dim_neighbourhood", "noise_borough_month", "weather")
    LARGE = ("dim_host", "dim_listing", "fact_review")

    def __init__(self, spark: SparkSession, sf: str, published: bool = True):
        self._at = (spark, sf)
        self._written = self.SMALL + (self.CLEAN + self.LARGE if published else ())
        self._makers = {
            "listings": lambda: listings(spark, sf),
            "reviews": lambda: reviews(spark, sf),
            "places": lambda: clean_places(spark, sf),
            "weather": lambda: weather(spark, sf),
            "dim_date": lambda: gold.dim_date(self["reviews"]),
            "dim_neighbourhood": lambda: gold.dim_neighbourhood(self["listings"], self["places"], PLACE_TYPES),
            "dim_host": lambda: gold.dim_host(self["listings"]),
            "dim_listing": lambda: gold.dim_listing(self["listings"]),
            "noise_borough_month": lambda: gold.noise_borough_month(complaints(spark, sf)),
            "fact_review": lambda: gold.fact_review(self["reviews"], self["listings"], self["noise_borough_month"]),
            "fact_review_weather": lambda: gold.fact_review_weather(self["fact_review"], self["weather"]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        make = self._makers[name]
        return once(*self._at, name, make) if name in self._written else make()

    def __iter__(self):
        return iter([*gold.LOAD_ORDER, "weather"])

    def __len__(self) -> int:
        return len(gold.LOAD_ORDER) + 1


def star(spark: SparkSession, sf: str) -> Star:
    return Star(spark, sf)


def star_plans(spark: SparkSession, sf: str) -> Star:
    return Star(spark, sf, published=False)
