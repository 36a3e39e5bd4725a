"""Table and reader schemas, and what can be derived from them (DDL, casts)."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderpulse.functions.values import MONEY_SUM

#: Table formats that run MERGE and replace a table that is being read.
MERGING_FORMATS = ("iceberg", "delta")


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table. Partition columns come last, as parquet tables keep them."""

    name: str
    columns: tuple[tuple[str, str], ...]
    partition: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    format: str = "parquet"
    # A table that changes by key or only grows is kept as a log of batches, and `name` is a view that folds them: the key
    # and the column whose change makes a row new, or the columns that are distinct. Formats with MERGE need no log.
    upsert: tuple[str, str] | None = None
    union: tuple[str, ...] = ()
    # Rows of one value of this column lie in one of so many buckets, sorted: joins on it leave the table where it is. The
    # count is the stored table's; another one here holds for tables that are made later.
    clustered: tuple[str, int] | None = None
    # What readers see instead of the stored columns, and under which name.
    view: tuple[str, tuple[str, ...]] | None = None

    def __post_init__(self):
        names = [n for n, _ in self.columns]
        if names[len(names) - len(self.partition):] != list(self.partition):
            raise ValueError(f"{self.name}: partition columns must be the last columns")

    @property
    def column_names(self) -> list[str]:
        return [n for n, _ in self.columns]

    @property
    def logged(self) -> bool:
        return bool(self.upsert or self.union) and self.format not in MERGING_FORMATS

    @property
    def read_name(self) -> str:
        return self.view[0] if self.view else self.name

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns))

    def with_format(self, fmt: str) -> TableSpec:
        return replace(self, format=fmt)

    def create_sql(self, database: str) -> str:
        columns = ",\n  ".join(f"`{n}` {t}" for n, t in self.columns)
        sql = f"CREATE TABLE IF NOT EXISTS `{database}`.`{self.name}` (\n  {columns}\n) USING {self.format}"
        if self.partition:
            sql += "\nPARTITIONED BY (" + ", ".join(f"`{p}`" for p in self.partition) + ")"
        if self.clustered:
            column, buckets = self.clustered
            sql += f"\nCLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {buckets} BUCKETS"
        return sql

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the table's columns by name, in table order, with the table's types."""
        return df.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in self.columns])


# Orders and lines are stored by writer, epoch and day. Readers see the day, and year, month and
# day made from it, so that a filter on any of them prunes partitions.
_WRITE_KEYS = (("stream_id", "STRING"), ("epoch", "BIGINT"), ("order_date", "DATE"))
_DAY_COLUMNS = ("year(order_date) AS year", "month(order_date) AS month", "day(order_date) AS day", "order_date")

PRODUCTS = TableSpec(
    "products",
    (("product_id", "STRING"), ("product_name", "STRING"), ("price", "DOUBLE"), ("ingest_date", "DATE")),
    partition=("ingest_date",),
    required=("product_id",),
)
ORDERS = TableSpec(
    "orders_stored",
    (("order_id", "STRING"), ("customer_id", "STRING"), ("amount", "DOUBLE"), ("timestamp", "TIMESTAMP"), *_WRITE_KEYS),
    partition=("stream_id", "epoch", "order_date"),
    required=("order_id", "customer_id", "timestamp"),
    view=("orders", ("order_id", "customer_id", "amount", "timestamp", *_DAY_COLUMNS)),
)
ORDER_LINES = TableSpec(
    "order_lines_stored",
    (("order_id", "STRING"), ("product_id", "STRING"), ("price", "DOUBLE"), ("volume", "INT"),
     ("timestamp", "TIMESTAMP"), *_WRITE_KEYS),
    partition=("stream_id", "epoch", "order_date"),
    required=("order_id", "product_id"),
    view=("order_lines", ("order_id", "product_id", "price", "volume", "timestamp", *_DAY_COLUMNS)),
)
CUSTOMERS = TableSpec(
    "customers",
    (("customer_id", "STRING"), ("company_name", "STRING"), ("ingest_date", "DATE")),
    partition=("ingest_date",),
    required=("customer_id",),
    upsert=("customer_id", "company_name"),
)
COMPANIES = TableSpec(
    "companies",
    (("company_name", "STRING"), ("industry", "STRING"), ("ingest_date", "DATE")),
    partition=("ingest_date",),
    required=("company_name",),
    union=("company_name", "industry"),
)
INDUSTRIES = TableSpec(
    "industries",
    (("industry", "STRING"), ("ingest_date", "DATE")),
    partition=("ingest_date",),
    required=("industry",),
)
FLUCTUATIONS = TableSpec(
    "fluctuations",
    (("industry", "STRING"), ("rank", "INT"), ("value_24h", "DOUBLE"), ("avg_30d", "DOUBLE"),
     ("diff", "DOUBLE"), ("aggregation_date", "DATE")),
    partition=("aggregation_date",),
    required=("industry", "rank"),
)
# What a stream summed per entity and day, by batch; `late` marks rows that came after their day was closed.
ENTITY_DAYS = TableSpec(
    "entity_days",
    (("industry", "STRING"), ("date", "DATE"), ("total", MONEY_SUM), ("stream_id", "STRING"), ("epoch", "BIGINT"),
     ("late", "BOOLEAN")),
    partition=("stream_id", "epoch", "late"),
    required=("industry", "date"),
)
# Daily sums that are kept up to date, by refresh: sums add up over refreshes and may be negative in one.
_SUMS = (("total", MONEY_SUM), ("n_rows", "BIGINT"), ("n_values", "BIGINT"), ("refresh", "BIGINT"))
_BY_MEMBER = ("customer_id", 16)
MEMBER_DAYS = TableSpec("member_days", (("customer_id", "STRING"), ("date", "DATE"), *_SUMS), ("refresh",), ("customer_id", "date"),
                        clustered=_BY_MEMBER)
INDUSTRY_DAYS = TableSpec("industry_days", (("industry", "STRING"), ("date", "DATE"), *_SUMS), ("refresh",), ("industry", "date"))
MEMBER_INDUSTRIES = TableSpec(
    "member_industries", (("customer_id", "STRING"), ("industry", "STRING"), ("refresh", "BIGINT")), ("refresh",),
    ("customer_id", "industry"), clustered=_BY_MEMBER)
REFRESHES = TableSpec("refreshes", (("stream_id", "STRING"), ("epoch", "BIGINT"), ("refresh", "BIGINT")), ("refresh",))
# Messages that hold no order document.
ORDER_REJECTS = TableSpec(
    "order_rejects_stored",
    (("value", "STRING"), ("stream_id", "STRING"), ("epoch", "BIGINT")),
    partition=("stream_id", "epoch"),
    view=("order_rejects", ("value", "stream_id", "epoch")),
)

# Files that a stream took, by what is in them.
DELIVERIES = TableSpec(
    "deliveries",
    (("file", "STRING"), ("n_rows", "BIGINT"), ("print_1", "DECIMAL(38,0)"), ("print_2", "DECIMAL(38,0)"), ("stream_id", "STRING"),
     ("epoch", "BIGINT")),
    partition=("stream_id", "epoch"),
)
# Violations that loads and streams counted, by what wrote them.
LOAD_CHECKS = TableSpec(
    "load_checks",
    (("column_name", "STRING"), ("problem", "STRING"), ("n_rows", "BIGINT"), ("stream_id", "STRING"), ("epoch", "BIGINT"),
     ("table_name", "STRING")),
    partition=("stream_id", "epoch", "table_name"),
)

WAREHOUSE = (PRODUCTS, ORDERS, ORDER_LINES, CUSTOMERS, COMPANIES, INDUSTRIES, FLUCTUATIONS)

#: Tells a document that only goes on with the lines of a long order from the order itself.
FRAGMENT = "_orderpulse_fragment"
# Columns of the raw inputs and of the documents.
CUSTOMERS_CSV = (
    T.StructType().add("customer_id", "string").add("company_name", "string").add("specialized_industries", "string")
)
INDUSTRIES_CSV = T.StructType().add("industry", "string")
PRODUCTS_CSV = T.StructType().add("product_id", "string").add("product_name", "string").add("price", "double")
ORDER_DOCUMENT = (
    T.StructType()
    .add("order_id", "string")
    .add("customer_id", "string")
    .add("order_lines", T.ArrayType(
        T.StructType().add("price", "double").add("product_id", "string").add("volume", "integer")))
    .add("amount", "double")
    .add("timestamp", "timestamp")
    # Ours, under a name that no producer uses: a document that goes on with the lines of a long order has a number.
    .add(FRAGMENT, "integer")
)
# Row contract of a message source: what a Kafka subscription returns and we read.
MESSAGE = (
    T.StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
)
