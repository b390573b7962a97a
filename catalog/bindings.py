"""Test tables seen as weather, air-quality and traffic feeds.

Each feed is a list of column expressions both engines read the same way; the few that
differ are filled in per engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroweave.operators import clean, features, merge
from aeroweave.session import prepare

SPARK = {
    "hour": "cast(date_trunc('hour', ts) as timestamp_ntz)",
    "order_ts": "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))",
    "ship_ts": "l_shipdate + make_dt_interval(0, cast(l_orderkey % 24 as int))",
    "ship_date": "to_date(l_shipdate)",
    "next_date": "date_add(to_date(l_shipdate), 1)",
}
DUCK = {
    "hour": "date_trunc('hour', ts)",
    "order_ts": "o_orderdate + (o_orderkey % 24) * interval 1 hour",
    "ship_ts": "l_shipdate + (l_orderkey % 24) * interval 1 hour",
    "ship_date": "cast(l_shipdate as date)",
    "next_date": "cast(l_shipdate as date) + 1",
}

# name -> (source table, columns)
FEEDS = {
    "bronze_weather": ("events", {
        "city_key": "concat(event_type, '_', cast(user_id % 2 as string))",
        "datetime": "{hour}",
        "_seq": "event_id",
        "temperature": "case when event_id % 11 = 0 then null when event_id % 13 = 0 then value * 20.0 "
                       "else value / 4.0 - 10.0 end",
        "humidity": "cast((event_id * 7) % 131 - 10 as double)",
        "wind_speed": "cast(event_id % 60 as double) - 3.0",
        "precipitation": "cast(event_id % 5 as double) * 0.4",
        "pressure": "case when event_id % 19 = 0 then null else 980.0 + cast(event_id % 60 as double) end",
        "wind_direction": "cast(event_id % 360 as double)",
        "snow": "case when event_id % 7 = 0 then null else cast(event_id % 3 as double) end",
        "wpgt": "case when event_id % 2 = 0 then null else value end",
        "tsun": "case when event_id % 9 = 0 then null else cast(event_id % 61 as double) end",
        "temp_min": "value / 4.0 - 15.0",
        "temp_max": "value / 4.0 - 6.0",
        "city": "concat(event_type, '_', cast(user_id % 2 as string))",
        "lat": "47.0 + cast(user_id % 2 as double)",
        "lon": "case when event_id % 21 = 0 then null else 6.0 + cast(user_id % 2 as double) end",
        "weather_code": "cast(event_id % 27 as double)",
    }),
    "bronze_air": ("events", {
        # one city of the other feeds is missing here, and one is only here
        "city_key": "concat(case when event_type = 'signup' then 'annex' else event_type end, '_', "
                    "cast((user_id + 1) % 2 as string))",
        "datetime": "{hour}",
        "_seq": "event_id",
        "station_id": "cast(user_id as string)",
        "station_code": "concat('ST', cast(user_id % 7 as string))",
        "no2": "case when event_id % 11 = 0 then null when event_id % 13 = 0 then -value else value end",
        "pm10": "case when event_id % 17 = 0 then null else value * 1.5 - 5.0 end",
        "o3": "cast(event_id % 120 as double)",
        "pm25": "case when event_id % 23 = 0 then null else value * 0.9 end",
        "co": "cast(event_id % 9 as double)",
    }),
    "bronze_traffic": ("events", {
        "city_key": "concat(event_type, '_', cast(event_id % 2 as string))",
        "datetime": "{hour}",
        "_seq": "event_id",
        "current_speed": "case when event_id % 29 = 0 then null else cast(10 + event_id % 41 as double) end",
        "free_flow_speed": "cast(50 as double)",
        "confidence": "cast(event_id % 10 as double) / 10.0",
        "congestion_level": "1.0 - cast(10 + event_id % 41 as double) / 50.0",
        "traffic_index": "case when event_id % 31 = 0 then 120.0 "
                         "else 100.0 * (1.0 - cast(10 + event_id % 41 as double) / 50.0) end",
        "is_rush_hour": "case when event_id % 37 = 0 then null else event_id % 3 = 0 end",
        "is_weekend": "event_id % 4 = 1",
        "is_holiday": "event_id % 50 = 0",
        "holiday_name": "case when event_id % 50 = 0 then 'Fair' end",
        "data_source": "case when event_id % 4 = 0 then 'flow' else 'synthetic' end",
    }),
    # every event as one reading with all measures, for single-value functions
    "readings": ("events", {
        "event_id": "event_id",
        "city_key": "event_type",
        "ts": "ts",
        "datetime": "{hour}",
        "temperature": "case when event_id % 11 = 0 then null else value / 4.0 - 10.0 end",
        "steps": "cast(event_id % 61 as double) - 10.0",
        "humidity": "cast((event_id * 7) % 101 as double)",
        "wind_speed": "cast(event_id % 60 as double) / 4.0",
        "precipitation": "cast(event_id % 5 as double) * 0.25",
        "pressure": "980.0 + cast(event_id % 60 as double)",
        "no2": "case when event_id % 13 = 0 then null else value end",
        "pm10": "case when event_id % 17 = 0 then null else cast(event_id % 700 as double) end",
        "pm25": "case when event_id % 19 = 0 then null else cast(event_id % 520 as double) / 2.0 end",
        "o3": "cast(event_id % 120 as double)",
        "traffic_index": "cast(event_id % 102 as double)",
        "congestion": "cast(event_id % 12 as double) / 10.0",
        "current_speed": "cast(event_id % 45 as double)",
        "free_flow_speed": "cast(event_id % 55 as double)",
    }),
    # order times spread over years, for calendar functions
    "stamps": ("orders", {"id": "o_orderkey", "ts": "{order_ts}"}),
    # stations spread over the country
    "stations": ("customer", {
        "station_id": "c_custkey",
        "city": "case c_custkey % 8 when 0 then 'Berlin' when 1 then 'berlin neukölln' when 2 then 'MÜNCHEN' "
                "when 3 then 'Frankfurt' when 4 then 'Halle (Saale)' when 5 then 'Bad Homburg' "
                "when 6 then 'Mülheim an der Ruhr' else 'Nowhere' end",
        "lat": "47.5 + cast(c_custkey * 37 % 7411 as double) / 1000.0",
        "lon": "6.0 + cast(c_custkey * 53 % 8713 as double) / 1000.0",
    }),
}

# line items as long hourly feeds keyed by nation; unique per city and instant
SHIPMENTS = {
    "shipments": (
        "lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey",
        {
            "city": "n_name",
            "city_key": "n_name",
            "datetime": "{ship_ts}",
            "date": "{ship_date}",
            "no2": "l_quantity * 2.0",
            "pm10": "case when l_linenumber = 7 then null else l_extendedprice / 1000.0 end",
            "o3": "l_discount * 400.0",
            "pm25": "l_quantity + l_tax * 100.0",
            "temperature": "l_tax * 300.0 - 5.0",
            "pressure": "1000.0 + l_quantity",
            "traffic_index": "l_discount * 900.0",
            "next_date": "{next_date}",
        },
    )
}
MEASURES = ("no2", "pm10", "o3", "pm25", "temperature", "pressure", "traffic_index")


def duck_feed(name: str) -> str:
    source, columns = (FEEDS | SHIPMENTS)[name]
    listed = ",\n       ".join(f"{expr.format(**DUCK)} as {col}" for col, expr in columns.items())
    return f"select {listed}\nfrom {source}"


class Tables:
    """The feeds as DataFrames, and the tables the library makes of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def feed(self, name: str) -> DataFrame:
        source, columns = FEEDS[name]
        return self.read(source).selectExpr(
            *[f"{expr.format(**SPARK)} as {col}" for col, expr in columns.items()]
        )

    @cached_property
    def bronze(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.feed("bronze_weather"), self.feed("bronze_air"), self.feed("bronze_traffic")

    @cached_property
    def silver_weather(self) -> DataFrame:
        return clean.clean_weather(self.feed("bronze_weather"))

    @cached_property
    def silver_air(self) -> DataFrame:
        return clean.clean_air_quality(self.feed("bronze_air"))

    @cached_property
    def silver_traffic(self) -> DataFrame:
        return clean.clean_traffic(self.feed("bronze_traffic"))

    @property
    def silver(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return self.silver_weather, self.silver_air, self.silver_traffic

    @cached_property
    def gold(self) -> DataFrame:
        return features.gold_features(merge.gold_merge(*self.silver))

    @cached_property
    def shipments(self) -> DataFrame:
        _, columns = SHIPMENTS["shipments"]
        joined = (
            self.read("lineitem")
            .join(self.read("supplier"), F.expr("l_suppkey = s_suppkey"))
            .join(self.read("nation"), F.expr("s_nationkey = n_nationkey"))
        )
        return joined.selectExpr(*[f"{expr.format(**SPARK)} as {col}" for col, expr in columns.items()])

    @cached_property
    def hourly(self) -> DataFrame:
        """Shipments averaged per city and instant."""
        return self.shipments.groupBy("city_key", "datetime").agg(*[F.avg(c).alias(c) for c in MEASURES])

    @cached_property
    def study_feeds(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """air (rows), weather (daily), traffic (daily, a day later)."""
        rows = self.shipments

        def daily(date: str, **means: str) -> DataFrame:
            aggs = [F.avg(F.expr(expr)).alias(name) for name, expr in means.items()]
            return rows.groupBy("city", F.col(date).alias("date")).agg(*aggs)

        weather = daily("date", temperature="temperature", temp_min="temperature - 4.0", temp_max="temperature + 5.0",
                        wind_speed="pm25", precipitation="o3", pressure="pressure", wpgt="no2")
        traffic = daily("next_date", traffic_index="traffic_index", congestion_level="traffic_index / 100.0",
                        current_speed="no2")
        return rows.select("city", "date", "no2", "pm10", "o3"), weather, traffic

    @cached_property
    def study(self) -> DataFrame:
        return merge.study_merge(*self.study_feeds)
