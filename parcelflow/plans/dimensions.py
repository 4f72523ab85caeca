"""Building dimension tables from source changes under a routing config."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.functions.masking import MASKING_POLICY, Mask, mask_map
from parcelflow.operators.changes import computed_once, drop_unusable, keep_columns, parse_images, route, split_list
from parcelflow.operators.latest import current_state, latest_by
from parcelflow.sources.schemas import ANY_IMAGE, DIM_CONFIG

# Fixed value: column family of a dimension whose config names none.
DEFAULT_FAMILY = "info"


def sink_family(family: Column | str) -> Column:
    family = F.col(family) if isinstance(family, str) else family
    return F.coalesce(F.nullif(family, F.lit("")), F.lit(DEFAULT_FAMILY))


def current_config(changes: DataFrame) -> DataFrame:
    """Routing config in force: newest image per source table, deleted rows gone.

    Needs ``ts`` and ``seq`` to order changes of the same row.
    """
    typed = parse_images(changes.where(F.coalesce("after", "before").isNotNull()), DIM_CONFIG)
    images = typed.select("op", "ts", "seq", F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")).alias("row"))
    flat = images.select("op", "ts", "seq", "row.*")
    return current_state(flat, ["source_table"], ["ts", "seq"], apply_deletes=True).select(*DIM_CONFIG.fieldNames())


def route_dimensions(
    changes: DataFrame,
    config: DataFrame,
    policy: dict[str, dict[str, Mask]] = MASKING_POLICY,
    apply_deletes: bool = False,
) -> DataFrame:
    """Changes of configured tables -> dimension rows ready to be stored.

    Out: ``sink_table``, ``pk`` (value of the configured key), ``op``, ``ts``, ``row`` (a
    masked, pruned map of texts without the key), ``foreign_key`` (see
    :func:`changed_keys`) and whatever else ``changes`` had.  Deletes do not reach
    dimensions unless ``apply_deletes``.
    """
    extra = [c for c in changes.columns if c not in ("table", "op", "ts", "before", "after")]
    usable = changes.where(F.coalesce("after", "before").isNotNull()) if apply_deletes else drop_unusable(changes)
    lists = config.select(
        "source_table",
        "sink_table",
        "sink_pk",
        F.array_remove(split_list("sink_columns"), F.col("sink_pk")).alias("_columns"),
        split_list("foreign_keys").alias("_foreign"),
    )
    routed = route(parse_images(usable, ANY_IMAGE), lists)
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    stored = F.struct(
        image[F.col("sink_pk")].alias("pk"),
        mask_map(F.col("table"), keep_columns(image, F.col("_columns")), policy).alias("row"),
        F.when(F.col("op") == "u", foreign_values()).alias("foreign_key"),
    )
    return computed_once(routed, "_stored", stored).select(
        "sink_table", "_stored.pk", "op", "ts", *extra, "_stored.row", "_stored.foreign_key", "sink_pk"
    )


def foreign_values() -> Column:
    """Per configured foreign key: the old value if the update changed it, else the current one.

    Read from the full images, so a key need not be among the stored columns.
    """
    before, after = F.col("before"), F.col("after")
    return F.map_from_entries(
        F.transform(
            F.array_distinct("_foreign"),
            lambda key: F.struct(
                key.alias("key"),
                F.when(before.isNotNull() & ~before[key].eqNullSafe(after[key]), before[key])
                .otherwise(after[key])
                .alias("value"),
            ),
        )
    )


def changed_keys(routed: DataFrame) -> DataFrame:
    """Which dimension rows an update touched: by primary key and by each foreign key.

    Out: ``sink_table``, ``key_name``, ``key_value``.  Useful to find what must be
    recomputed after a dimension change.
    """
    own = F.map_from_arrays(F.array("sink_pk"), F.array("pk"))
    others = F.map_filter("foreign_key", lambda key, _: key != F.col("sink_pk"))
    return routed.where(F.col("op") == "u").select(
        "sink_table", F.explode(F.map_concat(own, others)).alias("key_name", "key_value")
    )


def newest_rows(rows: DataFrame, order: Iterable[str] = ("ts", "seq")) -> DataFrame:
    """One row per dimension key: the newest.  A deleted key keeps its delete."""
    return latest_by(rows, ["sink_table", "pk"], list(order))


def dimension_table(rows: DataFrame, sink_table: str, sink_pk: str, columns: list[str], order: Iterable[str] = ("ts", "seq")) -> DataFrame:
    """Current rows of one dimension, every column a text.

    Prunes to the table before looking for the newest rows.
    """
    newest = newest_rows(rows.where(F.col("sink_table") == sink_table), order).where(F.col("op") != "d")
    others = [c for c in columns if c != sink_pk]
    return newest.select(F.col("pk").alias(sink_pk), *[F.col("row")[c].alias(c) for c in others])
