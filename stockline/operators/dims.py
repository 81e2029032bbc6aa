"""Attributes of stores and items joined to the sales fact.

No join carries a broadcast hint. Sides are joined to each other first, reduced
to one row per store or item and written, so that their true size is known
when the join with the fact is planned: a small one is broadcast and the fact
stays where it is; one that has outgrown the threshold is shuffled, with hot
keys split by the adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from stockline import spec
from stockline.functions.dates import with_calendar
from stockline.operators.clean import fill_strings, trim_last_blank
from stockline.operators.promo import one_hot_promotion
from stockline.session import on_file

LOCATION_COLUMNS = ["ZipCode", "ProvinceEN", "DistrictEN"]


@dataclass(frozen=True)
class Dimensions:
    """The side tables of a job."""

    locations: DataFrame
    lat_long: DataFrame
    categories: DataFrame
    category_groups: DataFrame
    stores: DataFrame


def one_per_key(dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """At most one row per key, so that a join cannot fan out.

    Of several rows the largest is kept, which prefers known values to NULL.
    """
    return (dim.groupBy(key).agg(F.max(F.struct(*columns)).alias("__row"))
            .select(key, *[F.col(f"__row.{c}").alias(c) for c in columns]))


def store_dimension(locations: DataFrame, lat_long: DataFrame | None = None,
                    stores: DataFrame | None = None) -> DataFrame:
    """One row per store: its place and, where the sides are given, position and attributes."""
    dim = trim_last_blank(one_per_key(locations, spec.STORE, LOCATION_COLUMNS), "ProvinceEN")
    if lat_long is not None:
        dim = with_lat_long(dim, lat_long)
    if stores is not None:
        attributes = [c for c in stores.columns if c != spec.STORE]
        dim = dim.join(one_per_key(stores, spec.STORE, attributes), spec.STORE, "full")
    return on_file(dim, "stores")


def with_location(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Zip code, province and district of the store."""
    return df.join(store_dimension(locations), spec.STORE, "left")


def with_lat_long(df: DataFrame, lat_long: DataFrame) -> DataFrame:
    """Mean position of the zip code or, where that is unknown, of the province."""
    def mean_by(key: str, suffix: str) -> DataFrame:
        return lat_long.groupBy(key).agg(
            F.avg("latitude").alias(f"latitude{suffix}"), F.avg("longitude").alias(f"longitude{suffix}"))

    joined = (df.join(mean_by("ZipCode", "__zip"), "ZipCode", "left")
              .join(mean_by("ProvinceEN", "__prov"), "ProvinceEN", "left"))
    return joined.withColumns({
        c: F.coalesce(f"{c}__zip", f"{c}__prov") for c in ("latitude", "longitude")
    }).drop(*[f"{c}__{s}" for c in ("latitude", "longitude") for s in ("zip", "prov")])


def lat_long_feature(df: DataFrame, locations: DataFrame, lat_long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Position of the store of each row, by one join."""
    positions = store_dimension(locations, lat_long).select(spec.STORE, "latitude", "longitude")
    rows = df.select(*dict.fromkeys([*keys, spec.STORE, spec.DATE, spec.MONTH]))
    return rows.join(positions, spec.STORE, "left").select(*keys, spec.DATE, spec.MONTH, "latitude", "longitude")


def with_category(df: DataFrame, categories: DataFrame, groups: DataFrame) -> DataFrame:
    """Category of the item and the group of the category, ``others`` if unknown.

    The two dimensions are joined to each other first: the fact is joined once.
    """
    items = one_per_key(categories, spec.ITEM, [spec.CATEGORY_2])
    grouped = items.join(one_per_key(groups, spec.CATEGORY_2, [spec.CATEGORY_1]), spec.CATEGORY_2, "left")
    return fill_strings(df.join(on_file(grouped, "items"), spec.ITEM, "left"), [spec.CATEGORY_1, spec.CATEGORY_2])


def with_store_cluster(df: DataFrame, stores: DataFrame) -> DataFrame:
    attributes = [c for c in stores.columns if c != spec.STORE]
    return df.join(on_file(one_per_key(stores, spec.STORE, attributes), "clusters"), spec.STORE, "left")


def with_price_features(df: DataFrame) -> DataFrame:
    price, off = F.col("avgPrice"), F.col("avgPrice") - F.col("avgPriceDis")
    return df.withColumns({
        "revenue": price - F.col("supPrice"),
        "discount": off,
        "percentage_discount": 100 * F.try_divide(off, price),
    })


def basic_features(df: DataFrame, dims: Dimensions, promo_cutoff: float = spec.PROMO_CUTOFF) -> DataFrame:
    """Promotion, location, position, calendar, category, store and price columns.

    Promotions come first: counting the codes then scans one column of the
    fact and none of the joins.
    """
    return (df.transform(one_hot_promotion, promo_cutoff)
            .join(store_dimension(dims.locations, dims.lat_long, dims.stores), spec.STORE, "left")
            .transform(with_calendar)
            .transform(with_category, dims.categories, dims.category_groups)
            .transform(with_price_features))
