"""The denormalising join chain and small joins around it.

A lookup is broadcast only after its rows were counted up to a limit; a larger one is joined by shuffle,
with skew splitting by the session.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.functions.geo import great_circle_km, region_of, same_place
from shopsight.session import together


def payments_per_order(payments: DataFrame, key: str = "order_id") -> DataFrame:
    """One row per order: total value, most installments, most frequent type (lowest on ties), number."""
    return payments.groupBy(key).agg(
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("payment_value"),
        F.max("payment_installments").alias("payment_installments"),
        F.mode("payment_type", True).alias("payment_type"),
        F.count("payment_sequential").alias("payment_methods_count"),
    )


def suffix_clashes(
    left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str]
) -> tuple[DataFrame, DataFrame]:
    """Rename columns (other than the key) that both sides have."""
    shared = [c for c in left.columns if c in right.columns and c != on]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in shared if suffixes[0]})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in shared if suffixes[1]})
    return left, right


def left_join(
    left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    left, right = suffix_clashes(left, right, on, suffixes)
    return left.join(right, on, "left")


LOOKUP_ROWS = 500_000


def sized_lookups(lookups: Mapping[str, DataFrame], rows: int = LOOKUP_ROWS) -> dict[str, DataFrame]:
    """Mark those with at most `rows` rows for broadcast, and name these first; counting stops just above, all at the same time."""
    frames = list(lookups.values())
    counts = dict(zip(lookups, together(frames[0].sparkSession, lambda df: df.limit(rows + 1).count(), frames)))
    return {n: F.broadcast(lookups[n]) if counts[n] <= rows else lookups[n] for n in sorted(lookups, key=lambda n: counts[n] > rows)}


def join_steps(tables: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame, str]]:
    """(step name, table joined, key) in reporting order; payments and categories are reduced beforehand."""
    products = left_join(tables["products"], tables["category_translation"], "product_category_name")
    return [
        ("order_items", tables["order_items"], "order_id"),
        ("products", products, "product_id"),
        ("customers", tables["customers"], "customer_id"),
        ("sellers", tables["sellers"], "seller_id"),
        ("reviews", tables["reviews"], "order_id"),
        ("payments", payments_per_order(tables["payments"]), "order_id"),
    ]


def _clash_names(parts: Sequence[tuple[DataFrame, str, tuple[str, str]]]) -> list[dict[str, str]]:
    """Of each table, {column: name in the merged frame}, as if the tables were joined one after the other."""
    names = [{c: c for c in df.columns} for df, _, _ in parts]
    for i, (df, key, (left, right)) in enumerate(parts[1:], 1):
        shared = {n for own in names[:i] for n in own.values()} & set(df.columns) - {key}
        for own in names[:i]:
            own.update({c: n + left for c, n in own.items() if n in shared})
        names[i].update({c: c + right for c in shared})
    return names


def merge_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Orders with items, products, customers, sellers, reviews and payments: every order is kept.

    Left joins on columns of the left side can be taken in any order. A lookup is joined to the table that holds its
    key, before anything else: a customer once per order and not once per item, and no column of an order moves with
    the product ids. The joins on the order id come last and share one partitioning by it, which the result keeps.
    """
    steps = {name: (table, key) for name, table, key in join_steps(tables)}
    chain = ("reviews", "payments", "order_items")
    parts = {"orders": (tables["orders"], "", ("", ""))}
    parts.update({n: (*steps[n], ("_x", "_y")) for n in (*chain, "products", "customers")})
    parts["sellers"] = (*steps["sellers"], ("_customer", "_seller"))
    names = dict(zip(parts, _clash_names(list(parts.values()))))
    ready = {n: df.withColumnsRenamed(names[n]) for n, (df, _, _) in parts.items()}
    rest = []
    for name, table in sized_lookups({n: ready[n] for n in ("products", "customers", "sellers")}).items():
        key = steps[name][1]
        home = next((n for n in ("order_items", "orders") if key in ready[n].columns), None)
        if home:
            ready[home] = ready[home].join(table, key, "left")
        else:
            rest.append((table, key))
    merged = ready["orders"]
    for table, key in [*((ready[n], "order_id") for n in chain), *rest]:
        merged = merged.join(table, key, "left")
    order = [c for df in (tables["orders"], *(steps[n][0] for n in steps)) for c in df.columns]
    order += [c for own in names.values() for c in own.values()]
    return merged.select(*[c for c in dict.fromkeys(order) if c in merged.columns])


def merge_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per step: rows before and after, rows without a partner, keys repeated on the joined side.

    Row counts follow from key multiplicities (rows of a key times its matches), so no step of the wide
    join is materialised.
    """
    merged = tables["orders"]
    report = None
    for position, (name, table, key) in enumerate(join_steps(tables)):
        matches = table.groupBy(key).agg(F.count("*").alias("_m"))
        sides = merged.groupBy(key).agg(F.count("*").alias("_n")).join(matches, key, "left")
        grown = F.col("_n") * F.coalesce("_m", F.lit(1))
        row = sides.agg(
            F.sum("_n").alias("rows_before"),
            F.sum(grown).alias("rows_after"),
            F.sum(F.when(F.col("_m").isNull(), F.col("_n")).otherwise(0)).alias("rows_unmatched"),
            F.count_if(F.col("_m") > 1).alias("keys_repeated"),
        ).select(F.lit(position + 1).alias("step"), F.lit(name).alias("table"), "*")
        report = row if report is None else report.unionByName(row)
        merged = left_join(merged, table, key)
    return report


def orphan_counts(tables: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Referential integrity: rows of a child table whose key is not in the parent table."""
    report = None
    for child, parent, key in relations:
        lost = tables[child].where(F.col(key).isNotNull()).join(tables[parent].select(key), key, "left_anti")
        row = lost.agg(F.count("*").alias("orphans")).select(
            F.lit(child).alias("child"), F.lit(parent).alias("parent"), F.lit(key).alias("key"), "orphans"
        )
        report = row if report is None else report.unionByName(row)
    return report


def attach_role(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, role: str, columns: Mapping[str, str]) -> DataFrame:
    """Join a lookup under a role: its columns come back as <role>_<name>."""
    renamed = lookup.select(F.col(lookup_key).alias(key), *[F.col(c).alias(f"{role}_{n}") for c, n in columns.items()])
    return df.join(renamed, key, "left")


def attach_coordinates(df: DataFrame, geo: DataFrame) -> DataFrame:
    """Customer and seller coordinates from the same table of zip prefixes."""
    names = {"geolocation_lat": "lat", "geolocation_lng": "lng"}
    for role in ("customer", "seller"):
        df = attach_role(df, geo, f"{role}_zip_code_prefix", "geolocation_zip_code_prefix", role, names)
    return df


def distance_column() -> Column:
    return great_circle_km("customer_lat", "customer_lng", "seller_lat", "seller_lng")


def geographic_columns(median_km: float | None, regions: Mapping | None = None) -> dict[str, Column]:
    distance = distance_column()
    if median_km is not None:
        distance = F.coalesce(distance, F.lit(median_km))
    return {
        "seller_customer_distance_km": distance,
        "is_same_state": same_place("customer_state", "seller_state"),
        "customer_region": region_of("customer_state", regions),
        "seller_region": region_of("seller_state", regions),
    }


def attach_with_fill(df: DataFrame, features: DataFrame, key: str, fills: Mapping[str, object]) -> DataFrame:
    """Left join feature columns; rows whose key is unseen get the given fill values."""
    joined = df.join(features.select(key, *fills), key, "left")
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if v is not None}
    return joined.withColumns(filled) if filled else joined


def attach_segments(
    df: DataFrame,
    segments: DataFrame,
    key: str = "customer_unique_id",
    cluster: str = "cluster_id",
    segment: str = "customer_segment",
    new_label: str = "new_customer",
) -> DataFrame:
    joined = df.join(segments.select(key, cluster, segment), key, "left")
    return joined.withColumns(
        {
            cluster: F.coalesce(F.col(cluster), F.lit(-1)).cast("int"),
            segment: F.coalesce(F.col(segment), F.lit(new_label)),
        }
    )


def map_labels(df: DataFrame, labels: DataFrame, key: str, name: str) -> DataFrame:
    """Look up a name for each id in a two-column table (key, name)."""
    return df.join(labels.select(key, name), key, "left")
