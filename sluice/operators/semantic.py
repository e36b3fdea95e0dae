"""A semantic layer: named facts, dimensions and metrics with synonyms and
comments, queried as ``view.query(dimensions, metrics, ...)``.

Names resolve on the driver (a dictionary lookup); the query itself is one
``groupBy().agg()`` that Catalyst plans like hand-written SQL.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.plan import fence
from sluice.functions.timefn import lit_date, trunc_ntz, years_between_boundaries


@dataclass(frozen=True)
class Item:
    name: str
    expr: Callable[[dict], Column]      # ctx -> Column (ctx carries as_of)
    synonyms: tuple[str, ...] = ()
    comment: str = ""


@dataclass
class SemanticView:
    table: str
    key: str
    facts: dict[str, Item] = field(default_factory=dict)
    dimensions: dict[str, Item] = field(default_factory=dict)
    metrics: dict[str, Item] = field(default_factory=dict)
    synonyms: tuple[str, ...] = ()
    comment: str = ""

    def _index(self) -> dict[str, list[tuple[str, str]]]:
        idx: dict[str, list[tuple[str, str]]] = {}
        for kind, items in (("fact", self.facts), ("dimension", self.dimensions),
                            ("metric", self.metrics)):
            for it in items.values():
                for n in (it.name, f"{self.table}.{it.name}", *it.synonyms):
                    idx.setdefault(n.lower(), []).append((kind, it.name))
        return idx

    def resolve(self, name: str, kind: str | None = None) -> str:
        """Canonical name for a name or synonym; unknown or ambiguous names raise."""
        hits = self._index().get(name.strip().lower(), [])
        if kind:
            hits = [h for h in hits if h[0] == kind]
        hits = sorted(set(hits))
        if not hits:
            raise KeyError(f"unknown {kind or 'name'} {name!r}")
        if len(hits) > 1:
            raise KeyError(f"ambiguous name {name!r}: {hits}")
        return hits[0][1]

    def comments(self) -> dict[str, str]:
        return {it.name: it.comment for d in (self.facts, self.dimensions, self.metrics)
                for it in d.values()}

    def query(self, df: DataFrame, dimensions: Sequence[str] = (), metrics: Sequence[str] = (),
              where: Column | None = None, order_by: Sequence[Column | str] = (),
              limit: int | None = None, as_of: str | _dt.date = "2024-02-01",
              filters: dict | None = None) -> DataFrame:
        """``filters`` maps dimension names (or synonyms) to a value or a list
        of values; ``where`` is any extra Column predicate."""
        ctx = {"as_of": as_of}
        dims = [self.resolve(d, "dimension") for d in dimensions]
        mets = [self.resolve(m, "metric") for m in metrics]
        base = df
        for name, val in (filters or {}).items():
            expr = self.dimensions[self.resolve(name, "dimension")].expr(ctx)
            cond = expr.isin(list(val)) if isinstance(val, (list, tuple, set)) else expr == F.lit(val)
            where = cond if where is None else (where & cond)
        if where is not None:
            # The filter reads derived columns: stop it above their derivation
            # so an expensive input (a JSON parse) is not re-evaluated inside
            # the pushed-down condition.
            base = fence(base).where(where)
        # dimension filters may name dimensions: materialise them as columns first
        dim_cols = [self.dimensions[d].expr(ctx).alias(d) for d in dims]
        agg_cols = [self.metrics[m].expr(ctx).alias(m) for m in mets]
        out = base.groupBy(*dim_cols).agg(*agg_cols) if dims else base.agg(*agg_cols)
        if order_by:
            out = out.orderBy(*order_by)
        if limit is not None:
            out = out.limit(limit)
        return out

    def dimension(self, name: str, as_of: str = "2024-02-01") -> Column:
        return self.dimensions[self.resolve(name, "dimension")].expr({"as_of": as_of})


def _age(ctx) -> Column:
    return years_between_boundaries(F.col("date_of_birth"), lit_date(ctx["as_of"]))


def age_group(age: Column) -> Column:
    return (F.when(age < 25, "18-24").when(age < 35, "25-34").when(age < 45, "35-44")
            .when(age < 55, "45-54").when(age < 65, "55-64").otherwise("65+"))


def _col(name):
    return lambda ctx: F.col(name)


def users_view() -> SemanticView:
    """The streaming-analytics view over the landed users table."""
    v = SemanticView(
        table="users", key="user_id",
        synonyms=("registrations", "customers", "orders"),
        comment="Real-time user registrations and orders landed from a stream")
    v.facts = {
        "order_amount": Item("order_amount", _col("order_amount"),
                             comment="Dollar amount of the order placed at registration"),
        "user_id_value": Item("user_id_value", _col("user_id"),
                              comment="Unique identifier for each registered user"),
    }
    # Dimension names, synonyms and comments of the view.
    dims = [
        ("first_name", _col("first_name"), (), "First name of the registered user"),
        ("last_name", _col("last_name"), (), "Last name of the registered user"),
        ("email", _col("email"), (), "Email address of the registered user"),
        ("phone_number", _col("phone_number"), (), "Phone number of the registered user"),
        ("city", _col("city"), ("town",), "City where the user is located"),
        ("state", _col("state"), ("province", "region"), "State or province where the user is located"),
        ("country", _col("country"), ("nation",), "Country where the user is located"),
        ("registration_date", _col("registration_date"),
         ("signup date", "sign up date", "registered at"), "Timestamp when the user registered"),
        ("registration_day", lambda ctx: trunc_ntz("day", F.col("registration_date")),
         ("signup day",), "Day the user registered (date only)"),
        ("registration_hour", lambda ctx: trunc_ntz("hour", F.col("registration_date")),
         (), "Hour the user registered"),
        ("date_of_birth", _col("date_of_birth"), ("birthday", "dob", "birth date"),
         "Date of birth of the user"),
        ("age", _age, ("years old",), "Current age of the user in years"),
        ("age_group", lambda ctx: age_group(_age(ctx)),
         ("age bracket", "age range", "age decade", "demographic"), "Age group bucket for the user"),
    ]
    v.dimensions = {n: Item(n, e, s, c) for n, e, s, c in dims}

    def amt():
        return F.col("order_amount")

    # Metric names, synonyms and comments of the view.
    mets = [
        ("total_users", lambda ctx: F.count("user_id"),
         ("user count", "number of users", "registrations", "how many users"),
         "Total number of registered users"),
        ("total_revenue", lambda ctx: F.sum(amt()).cast("double"),
         ("total sales", "total orders", "revenue", "sales", "income"), "Total revenue from all orders"),
        ("avg_order_value", lambda ctx: F.round(F.avg(amt()).cast("double"), 4),
         ("average order", "average spend", "avg order size", "mean order"),
         "Average order amount per user"),
        ("max_order", lambda ctx: F.max(amt()).cast("double"),
         ("largest order", "biggest order", "highest order"), "Largest single order amount"),
        ("min_order", lambda ctx: F.min(amt()).cast("double"),
         ("smallest order", "lowest order"), "Smallest single order amount"),
        ("unique_countries", lambda ctx: F.count_distinct("country"),
         ("number of countries", "country count", "how many countries"),
         "Number of distinct countries represented"),
        ("unique_cities", lambda ctx: F.count_distinct("city"),
         ("number of cities", "city count"), "Number of distinct cities represented"),
        ("unique_states", lambda ctx: F.count_distinct("state"),
         ("number of states", "state count"), "Number of distinct states represented"),
    ]
    v.metrics = {n: Item(n, e, s, c) for n, e, s, c in mets}
    return v


def cdr_view() -> SemanticView:
    """A view over landed call detail records (for tower questions)."""
    v = SemanticView(table="calls", key="record_id", synonyms=("cdr", "call records"),
                     comment="Call detail records landed from the log")
    v.facts = {"duration_seconds": Item("duration_seconds", _col("duration_seconds")),
               "data_usage_mb": Item("data_usage_mb", _col("data_usage_mb"))}
    # Dimension and metric names and synonyms of the view.
    dims = [
        ("cell_tower_id", _col("cell_tower_id"), ("tower", "cell tower"), "Cell tower that carried the call"),
        ("call_type", _col("call_type"), ("type of call",), "VOICE, SMS, DATA, MMS or VOICEMAIL"),
        ("network_type", _col("network_type"), ("network",), "Radio network of the call"),
        ("plan_type", _col("plan_type"), ("plan",), "Subscriber plan"),
        ("call_day", lambda ctx: F.to_date("call_start"), ("day",), "Day the call started"),
    ]
    v.dimensions = {n: Item(n, e, s, c) for n, e, s, c in dims}
    mets = [
        ("total_calls", lambda ctx: F.count("record_id"), ("call volume", "number of calls"),
         "Number of calls"),
        ("dropped_calls", lambda ctx: F.count_if(F.col("disposition") == "DROPPED"), ("drops",),
         "Calls that dropped"),
        ("drop_rate", lambda ctx: F.round(F.avg((F.col("disposition") == "DROPPED").cast("double")), 6),
         ("call drop rate", "failure rate"), "Share of calls that dropped"),
        ("total_data_usage_mb", lambda ctx: F.round(F.sum("data_usage_mb"), 4),
         ("data usage", "bandwidth"), "Data used, in MB"),
    ]
    v.metrics = {n: Item(n, e, s, c) for n, e, s, c in mets}
    return v
