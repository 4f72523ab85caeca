"""Facts from the difference between the two images of an update.  All narrow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def became_set(before: Column, after: Column) -> Column:
    """True when a value went from null to something."""
    return before.isNull() & after.isNotNull()


@dataclass(frozen=True)
class Lifecycle:
    """Which status change means which fact, and which facts end the life of a key."""

    steps: tuple[tuple[str, str, str], ...]
    cancel_status: str
    cancel_fact: str
    closing_facts: tuple[str, ...]
    created_fact: str

    def fact_type(self, old: Column, new: Column) -> Column:
        """Fact of a status change, null where it means nothing."""
        fact = F.when(old.eqNullSafe(new), F.lit(None).cast("string"))
        for before, after, name in self.steps:
            fact = fact.when((old == before) & (new == after), F.lit(name))
        return fact.when(new == self.cancel_status, F.lit(self.cancel_fact))


# Status codes of an order.
ORDER_LIFECYCLE = Lifecycle(
    steps=(
        ("60010", "60020", "dwd_trade_pay_suc_detail"),
        ("60020", "60030", "dwd_trans_receive_detail"),
        ("60040", "60050", "dwd_trans_dispatch_detail"),
        ("60050", "60060", "dwd_trans_bound_finish_detail"),
        ("60060", "60070", "dwd_trans_deliver_detail"),
        ("60070", "60080", "dwd_trans_sign_detail"),
    ),
    cancel_status="60999",
    cancel_fact="dwd_trade_cancel_detail",
    closing_facts=("dwd_trans_sign_detail", "dwd_trade_cancel_detail"),
    created_fact="dwd_trade_order_detail",
)


def emit_facts(changes: DataFrame, outputs: dict[str, Column], name: str = "fact_type") -> DataFrame:
    """One row per fact a change gives rise to: none, one or several."""
    hits = F.array_compact(F.array(*[F.when(condition, F.lit(fact)) for fact, condition in outputs.items()]))
    return changes.withColumn(name, F.explode(hits))


def split_by(facts: DataFrame, names: list[str], column: str = "fact_type") -> dict[str, DataFrame]:
    """One stream of mixed facts -> one DataFrame per fact."""
    return {name: facts.where(F.col(column) == name) for name in names}
