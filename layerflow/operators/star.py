"""Star schema over the relational layer.

Dimensions get dense surrogate keys in natural order (U7, no single-task
window). Facts look dimensions up with equi-joins; Spark's adaptive planner
turns a join into a broadcast only when the runtime size of the dimension
is under ``spark.sql.autoBroadcastJoinThreshold`` — a checked size — and
keeps a shuffle join otherwise. Unmatched members get key -1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.operators.keys import dense_ids

# Channel labels named by the reference documentation.
CHANNEL_LABELS = [("AIRBNB", "Airbnb"), ("BOOKING", "Booking.com"), ("HOMEAWAY", "HomeAway/VRBO"),
                  ("DIRECT", "Direct")]
UNKNOWN_KEY = -1
AMENITY_FLAGS = ["has_elevator", "has_washing_machine", "has_dishwasher", "has_air_conditioning", "has_self_checkin"]


def date_key(c: Column) -> Column:
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def dim_date(reviews: DataFrame, date_cols=("arrival_date", "departure_date", "created_at", "response_date")) -> DataFrame:
    """One row per calendar day from the first to the last date found in
    the reviews. The day list is generated from the (min, max) pair, so its
    size is bounded by the calendar span, not by the data."""
    dates = [F.col(c).cast("date") for c in date_cols if c in reviews.columns] or [F.lit(None).cast("date")]
    mins, maxs = [F.min(d) for d in dates], [F.max(d) for d in dates]
    bounds = reviews.agg((F.least(*mins) if len(mins) > 1 else mins[0]).alias("lo"),
                         (F.greatest(*maxs) if len(maxs) > 1 else maxs[0]).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    return days.select(date_key(d).alias("date_key"), d, F.year(d).alias("year"), F.quarter(d).alias("quarter"),
                       F.month(d).alias("month"), F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day"),
                       F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def _yes_no(c: str) -> Column:
    return F.when(F.col(c) == 1, F.lit("Yes")).when(F.col(c) == 0, F.lit("No")).otherwise(F.lit("Unknown"))


def dim_property(properties: DataFrame, mapping: DataFrame) -> DataFrame:
    """Properties with their external id, amenity labels and status."""
    m = mapping.select("property_id", "external_property_id")
    p = properties.join(m, "property_id", "left")
    labels = {f"{c}_label": _yes_no(c) for c in AMENITY_FLAGS if c in p.columns}
    status = (F.when(F.col("is_inactive") == 1, F.lit("Inactive")).otherwise(F.lit("Active"))
              if "is_inactive" in p.columns else F.lit("Unknown"))
    p = p.withColumns(labels).withColumn("status", status)
    cols = ["property_id", "external_property_id", "team", "neighbourhood", "postcode_prefix", "postcode_suffix",
            "floor", "max_occupancy", *labels.keys(), "status"]
    return dense_ids(p.select(*[c for c in cols if c in p.columns]), ["property_id"], "property_key") \
        .select("property_key", *[c for c in cols if c in p.columns])


def channel_label(code: Column) -> Column:
    expr = F.lit("Other")
    for k, v in reversed(CHANNEL_LABELS):
        expr = F.when(code == k, F.lit(v)).otherwise(expr)
    return F.when(code.isNull(), F.lit("Unknown")).otherwise(expr)


def dim_sales_channel(reviews: DataFrame) -> DataFrame:
    """D3: distinct channel codes (a partial aggregate), labelled."""
    if "sales_channel_code" not in reviews.columns:
        reviews = reviews.withColumn("sales_channel_code", F.lit(None).cast("string"))
    codes = reviews.select("sales_channel_code").where(F.col("sales_channel_code").isNotNull()).distinct()
    codes = codes.withColumn("label", channel_label(F.col("sales_channel_code")))
    return dense_ids(codes, ["sales_channel_code"], "channel_key") \
        .select("channel_key", "sales_channel_code", "label")


def aspect_label(c: Column) -> Column:
    t = F.replace(c, F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


def dim_aspect(aspects: DataFrame) -> DataFrame:
    """Distinct aspects with a readable label."""
    a = aspects.select("aspect").where(F.col("aspect").isNotNull()).distinct() \
        .withColumn("label", aspect_label(F.col("aspect")))
    return dense_ids(a, ["aspect"], "aspect_key").select("aspect_key", "aspect", "label")


def _not_blank(c: str) -> Column:
    return F.coalesce(F.length(F.trim(F.col(c))) > 0, F.lit(False))


def fact_reviews(reviews: DataFrame, d_property: DataFrame, d_channel: DataFrame) -> DataFrame:
    """One row per review with date, property and channel keys. The
    property dimension holds the external id, so it is joined once on that."""
    pk = d_property.select("external_property_id", "property_key").where(F.col("external_property_id").isNotNull())
    ck = d_channel.select("sales_channel_code", "channel_key")
    # optional review columns that a feed may not carry are NULL
    reviews = reviews.withColumns({c: F.lit(None).cast(t) for c, t in (
        ("external_property_id", "bigint"), ("sales_channel_code", "string"), ("arrival_date", "date"),
        ("departure_date", "date"), ("created_at", "timestamp_ntz"), ("overall_score", "double"))
        if c not in reviews.columns})
    r = reviews.join(pk, "external_property_id", "left").join(ck, "sales_channel_code", "left")
    return r.select(
        "review_id",
        date_key(F.col("arrival_date")).alias("arrival_date_key"),
        date_key(F.col("departure_date")).alias("departure_date_key"),
        date_key(F.col("created_at")).alias("created_date_key"),
        F.coalesce("property_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias("property_key"),
        F.coalesce("channel_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias("channel_key"),
        F.col("overall_score"),
        F.datediff("departure_date", "arrival_date").alias("stay_nights"),
        _not_blank("response_text").alias("has_response") if "response_text" in reviews.columns else F.lit(False).alias("has_response"),
        _not_blank("positive_comment").alias("has_positive_comment") if "positive_comment" in reviews.columns else F.lit(False).alias("has_positive_comment"),
        _not_blank("negative_comment").alias("has_negative_comment") if "negative_comment" in reviews.columns else F.lit(False).alias("has_negative_comment"),
    )


def fact_review_aspects(aspects: DataFrame, facts: DataFrame, d_aspect: DataFrame) -> DataFrame:
    """One row per aspect score linked to aspect, property, channel and
    the arrival date of its review."""
    f = facts.select("review_id", "property_key", "channel_key", F.col("arrival_date_key").alias("date_key"))
    a = aspects.join(f, "review_id", "left").join(d_aspect.select("aspect", "aspect_key"), "aspect", "left")
    return a.select(
        "aspect_id", "review_id",
        F.coalesce("aspect_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias("aspect_key"),
        F.coalesce("property_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias("property_key"),
        F.coalesce("channel_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias("channel_key"),
        "date_key", "score")
