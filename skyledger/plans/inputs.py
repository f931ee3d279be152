"""The raw shapes of the sources, derived by expressions from whole general-purpose tables.

``oracle.py`` states the same derivations in SQL. Unusable rows are made on purpose, by
conditions on the data, so that every rejection rule has something to reject.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DATE = "2024-02-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(column: Column, options: dict[str, Column | str | None], otherwise: Column | str | None = None) -> Column:
    """The option named by ``column``."""
    def value(option: Column | str | None) -> Column:
        return option if isinstance(option, Column) else F.lit(option)

    chosen = F.when(F.lit(False), F.lit(None))
    for key, option in options.items():
        chosen = chosen.when(column == key, value(option))
    return chosen.otherwise(value(otherwise))


def text(*parts: Column | str) -> Column:
    return F.concat(*[part.cast("string") if isinstance(part, Column) else F.lit(part) for part in parts])


def day_text(ts: Column | str) -> Column:
    return F.to_date(ts).cast("string")


def event_number() -> Column:
    """A number from 0 to 99: the last two digits of an event's value in hundredths."""
    return F.floor(F.col("value") * 100).cast("int") % 100


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station per customer: blank flags, ids and places, and unknown countries among them."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key, n, segment = F.col("c_custkey"), F.col("n_nationkey"), F.col("c_mktsegment")

    def place(whole: Column, factor: int) -> Column:
        ten_thousandths = whole * 10000 + (key * factor) % 10000
        return (ten_thousandths / F.lit(10000.0)).cast("decimal(9,4)").cast("string")

    far = F.when(segment == "FURNITURE", F.lit(2)).otherwise(F.lit(0))
    latitude = place(n * 5 - 60 + far, 7919)
    longitude = place(n * 14 - 168, 6007)
    return (
        customer.join(nation, F.col("c_nationkey") == n)
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            text("GHCND:U", key).alias("noaa_station_id"),
            F.col("c_name").alias("station_name"),
            F.when(n == 24, F.lit("LOST")).when(n == 22, F.lit("")).otherwise(F.col("n_name")).alias("state"),
            F.when(n == 23, F.lit("NOLAND")).when(n == 21, F.lit("")).otherwise(F.col("r_name")).alias("country"),
            F.lit("NOAA").alias("source_api"),
            choose(segment, {"BUILDING": "TRUE", "AUTOMOBILE": " yes ", "MACHINERY": "", "HOUSEHOLD": "0"}, "no")
            .alias("ingest_enabled"),
            (key + 1).cast("int").alias("priority_rank"),
            F.when((segment == "MACHINERY") & (F.col("c_acctbal") < 0), F.lit("n/a")).otherwise(latitude)
            .alias("latitude"),
            longitude.alias("longitude"),
            F.when(segment != "HOUSEHOLD", text("K", key)).alias("nws_station_id"),
            F.when(segment == "BUILDING", text("M", key)).otherwise(F.lit("")).alias("meteostat_station_id"),
            F.when(segment == "AUTOMOBILE", latitude).otherwise(F.lit("")).alias("meteostat_query_latitude"),
            F.when(segment == "AUTOMOBILE", longitude).otherwise(F.lit("")).alias("meteostat_query_longitude"),
        )
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue station per part, as a nested record: repeated codes, blank places, late starts."""
    part = table(spark, sf_dir, "part")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key, kind, brand = F.col("p_partkey"), F.col("p_type"), F.col("p_brand")
    n = F.col("n_nationkey")
    index = F.col("p_size") % 25

    def place(whole: Column, factor: int) -> Column:
        return (whole * 10000 + (key * factor) % 10000) / F.lit(10000.0)

    country = (
        F.when((kind == "LARGE") & (n < 20), F.lit(""))
        .when(kind == "PROMO", F.lit("ELSEWHERE"))
        .otherwise(F.coalesce("r_name", F.lit("SEA")))
    )
    unplaced = brand == "Brand#2"
    return (
        part.join(nation, F.col("p_size") == n, "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            key.alias("position"),
            text("M", key).alias("id"),
            F.when(kind == "SMALL", F.col("p_name")).otherwise(text('{"en": "', F.col("p_name"), '"}')).alias("name"),
            country.alias("country"),
            F.when((brand == "Brand#1") & (kind != "LARGE"), F.lit(None))
            .otherwise(F.coalesce("n_name", F.lit("SEA"))).alias("region"),
            F.struct(
                F.when(kind.isin("SMALL", "STANDARD"), text("U", F.floor(key / 2))).alias("national"),
                F.when(kind.isin("SMALL", "PROMO"), text("K", F.floor(key / 3))).alias("icao"),
            ).alias("identifiers"),
            F.struct(
                F.when(~unplaced, place(index * 5 - 60, 4447)).alias("latitude"),
                F.when(~unplaced, place(index * 14 - 168, 2741)).alias("longitude"),
                F.col("p_retailprice").alias("elevation"),
            ).alias("location"),
            F.struct(
                F.struct(
                    text(key * 31 % 40 + 1990, "-01-01").alias("start"),
                    F.when((kind != "MEDIUM") | (brand != "Brand#3"), F.lit("2024-06-30")).alias("end"),
                ).alias("daily")
            ).alias("inventory"),
        )
    )


def raw_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long row per event: snow readings for low numbers, missing or bad fields for the highest."""
    k, user = F.col("k"), F.col("user_id")
    by_event = choose(
        F.col("event_type"),
        {"view": "TAVG", "click": "TMIN", "purchase": "TMAX", "error": "PRCP", "signup": "AWND"},
    )
    return table(spark, sf_dir, "events").withColumn("k", event_number()).select(
        F.lit("noaa").alias("source"),
        F.lit(RUN_DATE).alias("run_date"),
        F.when(k != 99, text("GHCND:U", user)).alias("noaa_station_id"),
        text("Station ", user).alias("station_name"),
        text("S", user % 50).alias("state"),
        F.lit("US").alias("country"),
        text(user % 90, ".25").alias("latitude"),
        text("-", user % 180, ".5").alias("longitude"),
        F.when(k == 97, F.lit("bad-date")).otherwise(day_text("ts")).alias("date"),
        F.when(k != 98, F.when(k < 8, F.lit("SNOW")).when(k < 14, F.lit("SNWD")).otherwise(by_event))
        .alias("datatype"),
        "value",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An intraday observation per event, as unnested from its payload."""
    return observation_rows(table(spark, sf_dir, "events"))


def observation_rows(events: DataFrame) -> DataFrame:
    k, user, event = F.col("k"), F.col("user_id"), F.col("event_type")
    return events.withColumn("k", event_number()).select(
        F.lit(RUN_DATE).alias("run_date"),
        text("feature-", F.col("event_id")).alias("feature_id"),
        F.when(k >= 10, text("obs-", F.col("event_id"))).otherwise(F.lit("")).alias("@id"),
        text("stations/K", user).alias("station"),
        F.when(k != 99, text("K", user)).alias("stationId"),
        F.when(event != "click", text("Site ", user, " ", k % 3)).alias("stationName"),
        text(F.col("ts"), "+00:00").alias("timestamp"),
        event.alias("textDescription"),
        F.struct(
            F.when(event != "error", F.col("value")).alias("value"), F.lit("wmoUnit:degC").alias("unitCode")
        ).alias("temperature"),
        F.struct(
            F.when(~event.isin("error", "signup"), k.cast("double")).alias("value"),
            F.when(k < 90, F.when(k % 2 == 0, F.lit("wmoUnit:km_h-1")).otherwise(F.lit("wmoUnit:m_s-1")))
            .alias("unitCode"),
        ).alias("windSpeed"),
        F.when(
            event != "purchase",
            F.struct(
                F.lit("Point").alias("type"),
                F.array((k % 3 - 100).cast("double"), (user % 90).cast("double")).alias("coordinates"),
            ),
        ).alias("geometry"),
    )


FEEDS = 10


def fed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number of the file they come in: three days a file, some rows one file late, some four."""
    own = F.least(F.lit(FEEDS - 1), F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 3))
    behind = F.when(event_number() == 7, 4).when(event_number() == 8, 1).otherwise(0)
    return table(spark, sf_dir, "events").withColumn("feed", F.least(F.lit(FEEDS - 1), own + behind).cast("int"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested payload per event: none, one or two features, under a present or legacy path."""
    k, user = F.col("k"), F.col("user_id")
    day = day_text("ts")

    def feature(name: str, measured: Column) -> Column:
        return F.struct(
            text(name, F.col("event_id")).alias("id"),
            F.struct(
                F.lit("Point").alias("type"),
                F.when(k < 50, F.array((k - 100).cast("double"), (user % 90).cast("double")))
                .otherwise(F.array((k - 100).cast("double"))).alias("coordinates"),
            ).alias("geometry"),
            F.struct(
                F.when(k >= 10, text("obs-", name, F.col("event_id"))).alias("@id"),
                text("stations/K", user).alias("station"),
                text("K", user).alias("stationId"),
                text("Site ", user).alias("stationName"),
                text(F.col("ts"), "+00:00").alias("timestamp"),
                F.col("event_type").alias("textDescription"),
                F.struct(measured.alias("value"), F.lit("wmoUnit:degC").alias("unitCode")).alias("temperature"),
                F.struct(k.cast("double").alias("value"), F.lit("wmoUnit:km_h-1").alias("unitCode"))
                .alias("windSpeed"),
            ).alias("properties"),
        )

    first, second = feature("a", F.col("value")), feature("b", F.lit(None).cast("double"))
    path = F.when(
        F.col("event_type") == "view", text("file:/data/raw/", day, "/nws_raw.json")
    ).otherwise(text("file:/data/raw/nws/run_date=", day, "/station=K", user, "/nws_raw.json"))
    return table(spark, sf_dir, "events").withColumn("k", event_number()).select(
        "event_id",
        path.alias("path"),
        F.when(F.col("event_type") == "signup", F.slice(F.array(first), 1, 0))
        .when(F.col("event_type") == "error", F.array(first, second))
        .otherwise(F.array(first)).alias("features"),
    )


def raw_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide row per line item; some without an id, some without any measure."""
    supplier, quantity = F.col("l_suppkey"), F.col("l_quantity")
    measured = (F.col("l_tax") > 0) | (F.col("l_discount") > 0)

    def measure(value: Column) -> Column:
        return F.when(measured, value)

    return table(spark, sf_dir, "lineitem").select(
        F.lit("meteostat").alias("source"),
        F.lit(RUN_DATE).alias("run_date"),
        F.when((F.col("l_tax") > 0) | (F.col("l_linenumber") > 1), text("GHCND:U", supplier)).alias("noaa_station_id"),
        text("Supplier ", supplier).alias("station_name"),
        text("S", supplier % 50).alias("state"),
        F.lit("US").alias("country"),
        text(supplier % 90, ".75").alias("latitude"),
        text("-", supplier % 180, ".25").alias("longitude"),
        text("M", supplier).alias("meteostat_station_id"),
        day_text("l_shipdate").alias("date"),
        measure(quantity).alias("temp"),
        measure(quantity - 5).alias("tmin"),
        measure(quantity + 5).alias("tmax"),
        measure(F.col("l_extendedprice")).alias("prcp"),
        measure(F.col("l_tax") * 100).alias("snwd"),
        measure(quantity).alias("wspd"),
        measure(F.when(F.col("l_linenumber") != 7, quantity * 2)).alias("wpgt"),
    )


def ghcn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A by-station file line per order, all text; blank, marked and unreadable values among them."""
    price, status, priority = F.col("o_totalprice"), F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.when(status == "F", text("GHCND:U", F.col("o_custkey"))).otherwise(text("U", F.col("o_custkey")))
        .alias("station_id"),
        F.when((status == "P") & (priority == "5-LOW"), text(F.date_format("o_orderdate", "yyyyMM"), "31"))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("raw_day"),
        choose(
            priority,
            {
                "1-URGENT": F.when(status == "O", F.lit("TAVG")).otherwise(F.lit("TMAX")),
                "2-HIGH": "TMIN",
                "3-MEDIUM": F.when(status == "O", F.lit("PRCP")).otherwise(F.lit("SNOW")),
                "4-NOT SPECIFIED": F.when(status == "O", F.lit("WT01")).otherwise(F.lit("SNWD")),
            },
            "AWND",
        ).alias("datatype"),
        F.when(price < 20000, F.lit("")).when(price < 40000, F.lit("-9999")).when(price < 60000, F.lit("abc"))
        .when(price < 80000, F.lit("nan")).otherwise(F.floor(price).cast("string")).alias("raw_value"),
        F.when(status == "O", F.lit("P")).alias("mflag"),
        F.when(priority == "2-HIGH", F.lit("I")).otherwise(F.lit("")).alias("qflag"),
        F.lit("W").alias("sflag"),
        F.when(status != "P", F.lit("2400")).alias("obs_time"),
    )


def station_year_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A station-year file line per order, stating its date in one of the known ways, or badly."""
    day, priority, price = F.col("o_orderdate"), F.col("o_orderpriority"), F.col("o_totalprice")
    in_parts = priority.isin("3-MEDIUM", "4-NOT SPECIFIED")
    stated = day_text(day)
    value = F.floor(price / 1000).cast("string")
    return table(spark, sf_dir, "orders").select(
        text("M", F.col("o_custkey")).alias("meteostat_station_id"),
        F.when(priority == "1-URGENT", F.when(price < 20000, F.lit("1996-02-31")).otherwise(stated)).alias("date"),
        F.when(priority == "2-HIGH", stated).alias("time"),
        F.when(in_parts, F.year(day).cast("string")).alias("year"),
        F.when(in_parts, F.month(day).cast("string")).alias("month"),
        F.when(in_parts & (price >= 50000), F.dayofmonth(day).cast("string"))
        .when(in_parts, F.lit("")).alias("day"),
        value.alias("temp"),
        F.when(price > 100000, value).otherwise(F.lit("")).alias("tmin"),
        F.when(price > 200000, value).otherwise(F.lit("NaN")).alias("tmax"),
        F.when(price > 300000, value).otherwise(F.lit("x")).alias("prcp"),
        F.lit(None).cast("string").alias("snwd"),
        value.alias("wspd"),
    )


def result_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed result page per order: two items, none, or no list at all."""
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")

    def item(datatype: str, value: Column) -> Column:
        return F.struct(
            stamp.alias("date"), F.lit(datatype).alias("datatype"), value.alias("value"),
            text(",,W,", F.col("o_orderkey")).alias("attributes"),
        )

    items = F.array(item("TMAX", F.floor(price).cast("string")), item("TMIN", F.when(price > 100000, F.lit("abc"))))
    return table(spark, sf_dir, "orders").select(
        text("GHCND:U", F.col("o_custkey")).alias("noaa_station_id"),
        F.when(status == "O", items).when(status == "F", F.slice(items, 1, 0)).alias("results"),
    )


def ghcn_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as by-station text lines: pending ones are cut short, filled ones have a field too many."""
    text = F.concat_ws(
        ",",
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("TMAX"),
        F.floor("o_totalprice").cast("string"), F.lit(""), F.lit(""), F.lit("W"),
    )
    tail = F.when(F.col("o_orderstatus") == "O", ",2400").when(F.col("o_orderstatus") == "F", ",,extra").otherwise("")
    return table(spark, sf, "orders").select(F.concat(text, tail).alias("value"))


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON lines: purchases state their value, every seventh line is broken."""
    whole = F.format_string('{"event_id": %d, "kind": "%s"}', "event_id", "event_type")
    priced = F.format_string('{"event_id": %d, "kind": "%s", "value": %d}', "event_id", "event_type", F.floor("value").cast("bigint"))
    line = F.when(F.col("event_type") == "purchase", priced).otherwise(whole)
    return table(spark, sf, "events").select(
        F.when(F.col("event_id") % 7 == 0, F.concat(F.lit('{"station_name": '), line)).otherwise(line).alias("value")
    )


def station_year_files(spark: SparkSession, sf: str) -> DataFrame:
    """A whole station-year file per customer and year, in one of three layouts, a line per order."""
    day, price, customer = F.to_date("o_orderdate"), F.floor("o_totalprice").cast("string"), F.col("o_custkey")
    layout = customer % 3
    line = (
        F.when(layout == 0, text(day, ",", price, ",x,7"))
        .when(layout == 1, text('"', price, '" , ', price, ',"', day, ' 00:00, noon"'))
        .otherwise(text(F.year(day), ",", F.month(day), ",", F.dayofmonth(day), ",,", price))
    )
    header = F.when(layout == 0, "date,temp,other,wspd,temp").when(layout == 1, '"PRCP", tmin ,Time,wpgt').otherwise("year,month,day,temp,tmax")
    lines = table(spark, sf, "orders").groupBy("o_custkey", F.year(day).alias("year")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    end = F.when(layout == 0, "\r\n").otherwise("\n")
    return lines.select(
        text("file:/data/", F.col("year"), "/M", customer, ".csv.gz").alias("path"),
        F.concat(header, end, F.concat_ws("\n", "lines"), end, end).alias("value"),
    )
