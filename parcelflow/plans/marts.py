"""The eight daily marts.

Each is a :class:`Mart`: what to count, by which key, and which dimensions to fill in.
Lookups that only add names run on the finished totals.  Those that decide the key run on
partial totals where these are much fewer than the facts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions import times
from parcelflow.operators.daily import (
    DAY,
    Measures,
    accumulate_ticks,
    merge_totals,
    partial_totals,
    tick_totals,
    with_day_columns,
)
from parcelflow.operators.lookup import lookup, org_city, region_chain
from parcelflow.sources.schemas import MARTS, conform

Dimensions = Mapping[str, DataFrame]
Enrich = Callable[[DataFrame, Dimensions], DataFrame]


def unchanged(df: DataFrame, dims: Dimensions) -> DataFrame:
    return df


@dataclass(frozen=True)
class Mart:
    """One daily mart.

    ``grain`` names the fact columns that matter (new name -> fact column), ``before``
    turns them into the key, ``after`` fills in names once totals are made.
    """

    table: str
    fact: str
    measures: Measures
    grain: Mapping[str, str] = field(default_factory=dict)
    keys: tuple[str, ...] = ()
    carried: tuple[str, ...] = ()
    before: Enrich | None = None
    after: Enrich = unchanged
    delay: str = "5 seconds"
    #: Whether ``before`` runs on partial totals.  Not worth it where the grain is about as
    #: fine as the facts.
    reduce_first: bool = True


def _org_of(df: DataFrame, dims: Dimensions) -> DataFrame:
    take = {"org_id": "id", "org_name": "org_name"}
    return lookup(df, dims["base_organ"], "district_id", take, key="region_id", unique=False)


def _org_name(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims["base_organ"], "org_id", {"org_name": "org_name"})


def _city_name(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims["base_region_info"], "city_id", {"city_name": "name"})


def _org_city_province_names(df: DataFrame, dims: Dimensions) -> DataFrame:
    named = _city_name(_org_name(df, dims), dims)
    return lookup(named, dims["base_region_info"], "province_id", {"province_name": "name"})


def _sort_places(df: DataFrame, dims: Dimensions) -> DataFrame:
    placed = lookup(df, org_city(dims["base_organ"]), "org_id", {"org_name": "org_name", "city_id": "city_id"})
    chain = region_chain(dims["base_region_info"])
    take = {"city_name": "city_name", "province_id": "province_id", "province_name": "province_name"}
    return lookup(placed, chain, "city_id", take)


def _truck_model(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims["truck_info"], "truck_id", {"truck_model_id": "truck_model_id"})


def _model_and_city(df: DataFrame, dims: Dimensions) -> DataFrame:
    named = lookup(df, dims["truck_model"], "truck_model_id", {"truck_model_name": "model_name"})
    return _city_name(lookup(named, org_city(dims["base_organ"]), "org_id", {"city_id": "city_id"}), dims)


def _cargo_type_name(df: DataFrame, dims: Dimensions) -> DataFrame:
    return lookup(df, dims["base_dic"], "cargo_type", {"cargo_type_name": "name"})


ALL_MARTS: dict[str, Mart] = {
    mart.table: mart
    for mart in (
        Mart(
            table="dws_trade_cargo_type_order_day_base",
            fact="dwd_trade_order_detail",
            grain={"cargo_type": "cargo_type"},
            keys=("cargo_type",),
            measures={"order_amount_base": "amount", "order_count_base": None},
            after=_cargo_type_name,
        ),
        Mart(
            table="dws_trade_org_order_day_base",
            fact="dwd_trade_order_detail",
            grain={"district_id": "sender_district_id", "city_id": "sender_city_id"},
            before=_org_of,
            keys=("org_id",),
            carried=("org_name", "city_id"),
            measures={"order_amount_base": "amount", "order_count_base": None},
            after=_city_name,
        ),
        Mart(
            table="dws_bound_org_sort_day_base",
            fact="dwd_bound_sort",
            grain={"org_id": "org_id"},
            keys=("org_id",),
            measures={"sort_count_base": None},
            after=_sort_places,
            delay="10 seconds",
        ),
        Mart(
            table="dws_trans_org_receive_day_base",
            fact="dwd_trans_receive_detail",
            grain={"district_id": "sender_district_id", "city_id": "sender_city_id", "province_id": "sender_province_id"},
            before=_org_of,
            keys=("org_id",),
            carried=("city_id", "province_id"),
            measures={"receive_order_count_base": None},
            after=_org_city_province_names,
        ),
        Mart(
            table="dws_trans_org_deliver_suc_day_base",
            fact="dwd_trans_deliver_detail",
            grain={
                "district_id": "receiver_district_id",
                "city_id": "receiver_city_id",
                "province_id": "receiver_province_id",
            },
            before=_org_of,
            keys=("org_id",),
            carried=("city_id", "province_id"),
            measures={"deliver_suc_count_base": None},
            after=_org_city_province_names,
        ),
        Mart(
            table="dws_trans_dispatch_day_base",
            fact="dwd_trans_dispatch_detail",
            measures={"dispatch_order_count_base": None},
        ),
        Mart(
            table="dws_trans_bound_finish_day_base",
            fact="dwd_trans_bound_finish_detail",
            measures={"bound_finish_order_count_base": None},
        ),
        Mart(
            table="dws_trans_org_truck_model_trans_finish_day_base",
            fact="dwd_trans_trans_finish",
            grain={"org_id": "start_org_id", "org_name": "start_org_name", "truck_id": "truck_id"},
            before=_truck_model,
            reduce_first=False,
            keys=("org_id", "truck_model_id"),
            carried=("org_name",),
            measures={
                "trans_finish_count_base": None,
                "trans_finish_distance_base": "actual_distance",
                "trans_finish_dur_time_base": "transport_time",
            },
            after=_model_and_city,
        ),
    )
}


def at_grain(facts: DataFrame, mart: Mart) -> DataFrame:
    """Only what the mart needs of its fact, under the mart's names."""
    values = [c for c in mart.measures.values() if c is not None]
    return facts.select(*[F.col(c).alias(name) for name, c in mart.grain.items()], *values, "ts")


def finish(totals: DataFrame, mart: Mart, dims: Dimensions, version: Column | None = None) -> DataFrame:
    """Totals per day and key -> rows in the layout of the mart's table."""
    return conform(mart.after(with_day_columns(totals, version), dims), MARTS[mart.table])


def daily_mart(
    facts: DataFrame,
    mart: Mart,
    dims: Dimensions,
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    version: Column | None = None,
) -> DataFrame:
    """Batch form of a mart: the last row each day and key would be published with."""
    rows, grain = at_grain(facts, mart), list(mart.grain)
    if mart.before is not None and not mart.reduce_first:
        rows, grain = mart.before(rows, dims), [*mart.keys, *mart.carried]
    partials = partial_totals(rows, grain, mart.measures, offset_hours=offset_hours)
    if mart.before is not None and mart.reduce_first:
        partials = mart.before(partials, dims)
    totals = merge_totals(partials, list(mart.keys), mart.measures, list(mart.carried))
    return finish(totals, mart, dims, version)


def mart_snapshots(
    facts: DataFrame,
    mart: Mart,
    dims: Dimensions,
    offset_hours: int = times.BUSINESS_OFFSET_HOURS,
    dense: bool = False,
) -> DataFrame:
    """Every running total a mart publishes during the day: keys, ``tick_ms``, measures."""
    rows, grain, keys = at_grain(facts, mart), list(mart.grain), list(mart.keys)
    if mart.before is not None and not mart.reduce_first:
        rows, grain = mart.before(rows, dims), keys
    ticks = tick_totals(rows, grain, mart.measures, offset_hours=offset_hours)
    if mart.before is not None and mart.reduce_first:
        sums = [F.sum(name).alias(name) for name in mart.measures]
        ticks = mart.before(ticks, dims).groupBy(DAY, *keys, "tick_ms").agg(*sums)
    return accumulate_ticks(ticks, keys, mart.measures, offset_hours, dense=dense)
