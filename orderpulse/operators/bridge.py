"""Company-industry bridge and the customer-industry dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.values import LIST_SEPARATOR, list_items
from orderpulse.operators.sizing import dimension_join, fits, right_outer, salted_join

BRIDGE = ["company_name", "industry"]


def explode_list(df: DataFrame, list_column: str, item: str, separator: str = LIST_SEPARATOR) -> DataFrame:
    """One row per list item, the list column replaced by the item. No row for a NULL list."""
    kept = [c for c in df.columns if c != list_column]
    return df.select(*kept, F.explode(list_items(F.col(list_column), separator)).alias(item))


def build_bridge(companies: DataFrame, list_column: str = "specialized_industries",
                 separator: str = LIST_SEPARATOR, keep_unclassified: bool = False) -> DataFrame:
    """Distinct (company_name, industry) from lists in text.

    `keep_unclassified` also keeps, with a NULL industry, each company whose rows all lack a
    list. A NULL company name equals no other, so it is kept if any of its rows lacks one.
    """
    pairs = explode_list(companies.select("company_name", list_column), list_column, "industry", separator).distinct()
    if not keep_unclassified:
        return pairs
    no_list = F.col(list_column).isNull()
    unclassified = (
        companies.groupBy("company_name")
        .agg(F.bool_and(no_list).alias("_none"), F.bool_or(no_list).alias("_some"))
        .filter(F.col("_none") | (F.col("company_name").isNull() & F.col("_some")))
        .select("company_name", F.lit(None).cast("string").alias("industry"))
    )
    return pairs.unionByName(unclassified)


def merge_bridge(existing: DataFrame, incoming: DataFrame, existing_distinct: bool = False) -> DataFrame:
    """Union of both without repeats. Pairs are only ever added, unclassified companies go.

    If `existing` has no repeats, as a stored bridge has none, and few pairs come in, only the
    new ones are looked for and `existing` is not shuffled.
    """
    classified = F.col("industry").isNotNull()
    existing, incoming = existing.select(BRIDGE).filter(classified), incoming.select(BRIDGE).filter(classified)
    if not (existing_distinct and fits(incoming)):
        return existing.unionByName(incoming).distinct()
    pairs = incoming.distinct()
    known = existing.alias("l").join(F.broadcast(pairs.alias("r")), _same_pair(), "left_semi")
    added = pairs.alias("l").join(F.broadcast(known.alias("r")), _same_pair(), "left_anti")
    return existing.unionByName(added)


def _same_pair() -> Column:
    """Equal pairs of `l` and `r`; companies without a name are the same one, as in `distinct`."""
    return F.col("l.company_name").eqNullSafe(F.col("r.company_name")) & (F.col("l.industry") == F.col("r.industry"))


def industry_lists(bridge: DataFrame) -> DataFrame:
    """(company_name, industries): each company's industries, sorted.

    A list holds the distinct industries of one company, so repeats in the input never
    gather in one task.
    """
    return (
        bridge.select(BRIDGE).filter(F.col("industry").isNotNull()).distinct()
        .groupBy("company_name")
        .agg(F.sort_array(F.collect_list("industry")).alias("industries"))
    )


def valid_companies(bridge: DataFrame, industries: DataFrame) -> DataFrame:
    """Every known industry with its companies, or NULL; unknown industries drop out."""
    return right_outer(bridge.select(BRIDGE), industries.select("industry"), "industry").select(BRIDGE)


def customer_industries(customers: DataFrame, bridge: DataFrame, industries: DataFrame) -> DataFrame:
    """(customer_id, industry), with a NULL customer for industries nobody belongs to.

    `customers` is a table, so that row positions can spread a company most customers share.
    """
    companies = valid_companies(bridge, industries)
    members = customers.select("customer_id", "company_name")
    return right_outer(members, companies, "company_name", F.monotonically_increasing_id()).select(
        "customer_id", "industry")


def entity_dim(customers: DataFrame, bridge: DataFrame, industries: DataFrame) -> DataFrame:
    """Distinct (customer_id, industry) as facts need it: customers of known industries only.

    With a small bridge the only shuffle is that of the distinct pairs. With a large one
    copies of customers go before the join, where a company most customers share is split.
    """
    known = dimension_join(bridge.select(BRIDGE).distinct(), industries.select("industry").distinct(), "industry")
    members = customers.select("customer_id", "company_name").filter(F.col("customer_id").isNotNull())
    if fits(known):
        joined = members.join(F.broadcast(known), "company_name")
    else:
        joined = salted_join(members.distinct(), known, "company_name")
    return joined.select("customer_id", "industry").distinct()
