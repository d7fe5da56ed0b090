"""The driver tables and the commerce views adapted from them."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.tiers import loyalty_tier
from tidewell.operators.scan import running_sum, row_number, scan
from tidewell.session import use_utc

# The category and action domains of the event schema.
EVENT_CATEGORIES = ["ELECTRONICS", "CLOTHING", "BOOKS", "HOME", "SPORTS"]
EVENT_ACTIONS = {"view": "view", "click": "add_to_cart", "purchase": "purchase", "signup": "login", "error": "remove"}
ORDER_STATUS = {"O": "completed", "F": "shipped", "P": "pending"}
MAX_BATCH_BYTES = str(1024**3)
USER_STATUS = {"O": "ACTIVE", "F": "SUSPENDED", "P": "INACTIVE"}


def recode(column: Column, values: dict[str, str]) -> Column:
    pairs = list(values.items())
    start = F.when(column == pairs[0][0], pairs[0][1])
    return reduce(lambda acc, kv: acc.when(column == kv[0], kv[1]), pairs[1:], start)


class Tables:
    """Lazy access to one data directory. Views join only the tables their columns need."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = use_utc(spark)
        self.path = path.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.read(name)

    def sales(self, *columns: str) -> DataFrame:
        """Sales facts, one row per order line."""
        sources = {
            "user_id": ("orders", F.col("o_custkey")),
            "action": ("orders", F.col("o_orderstatus")),
            "timestamp": ("orders", F.col("o_orderdate").cast("timestamp")),
            "session_id": ("lineitem", F.col("l_orderkey")),
            "product_id": ("lineitem", F.col("l_partkey")),
            "quantity": ("lineitem", F.col("l_quantity").cast("int")),
            "total_amount": ("lineitem", F.col("l_extendedprice")),
            "price": ("lineitem", F.col("l_extendedprice") / F.col("l_quantity")),
            "line": ("lineitem", F.col("l_linenumber")),
            "supplier_id": ("lineitem", F.col("l_suppkey")),
            "category": ("part", F.col("p_type")),
            "product_name": ("part", F.col("p_name")),
            "is_premium": ("customer", F.col("c_acctbal") > 5000),
            "region": ("region", F.col("r_name")),
            "country": ("nation", F.col("n_name")),
        }
        columns = columns or ("user_id", "product_id", "category", "action", "timestamp", "price", "quantity",
                              "total_amount", "session_id", "is_premium", "region")
        needed = {sources[c][0] for c in columns}
        fact = self.read("lineitem")
        if needed & {"orders", "customer", "nation", "region"}:
            fact = fact.join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if "part" in needed:
            fact = fact.join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
        if needed & {"customer", "nation", "region"}:
            fact = fact.join(self.read("customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        if needed & {"nation", "region"}:
            fact = fact.join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        if "region" in needed:
            fact = fact.join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        return fact.select(*[sources[c][1].alias(c) for c in columns])

    @property
    def users(self) -> DataFrame:
        return self.read("customer").join(
            self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        ).select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("tier"),
            F.col("c_acctbal").alias("balance"),
            (F.col("c_acctbal") > 5000).alias("is_premium"),
        )

    @property
    def products(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"),
            F.col("p_size").alias("size"),
            F.col("p_retailprice").alias("base_price"),
            F.round(F.col("p_retailprice") * 0.7, 2).alias("cost"),
            ((F.col("p_size") * 7 + F.col("p_partkey")) % 120).cast("int").alias("inventory"),
        )

    @property
    def user_orders(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            recode(F.col("o_orderstatus"), ORDER_STATUS).alias("status"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderdate").cast("timestamp").alias("order_date"),
            F.col("o_orderpriority").alias("payment_method"),
        )

    @property
    def events(self) -> DataFrame:
        return self.event_view(self.read("events"))

    @property
    def event_stream(self) -> DataFrame:
        """The same events as a file stream."""
        # A glob, because a file stream takes a plain path for a folder; this finds a file or a folder.
        # The byte limit bounds a micro-batch, and with it the rows of one key that a keyed job holds.
        reader = self.spark.readStream.schema(self.read("events").schema).option("maxBytesPerTrigger", MAX_BATCH_BYTES)
        source = reader.parquet(f"{self.path}/events.parque[t]")
        return self.event_view(source)

    def event_view(self, raw: DataFrame) -> DataFrame:
        product = F.get_json_object("props", "$.k").cast("long")
        return raw.select(
            "event_id",
            F.col("ts").cast("timestamp").alias("event_time"),
            "user_id",
            "event_type",
            recode(F.col("event_type"), EVENT_ACTIONS).alias("action"),
            product.alias("product_id"),
            F.element_at(F.array(*[F.lit(c) for c in EVENT_CATEGORIES]), (product % 5 + 1).cast("int")).alias("category"),
            F.col("value").alias("price"),
            F.lit(1).alias("quantity"),
            F.col("value").alias("total_amount"),
            F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
            F.concat(F.lit("10.0.0."), product % 7).alias("ip_address"),
            "props",
        )

    @property
    def user_changes(self) -> DataFrame:
        """Change log of users: one version per order, with the spend and tier reached by then."""
        orders = self.read("orders").select(
            F.col("o_custkey").alias("user_id"),
            "o_orderkey",
            F.col("o_orderdate").cast("timestamp").alias("updated_at"),
            recode(F.col("o_orderstatus"), USER_STATUS).alias("user_status"),
            (F.col("o_totalprice").cast("decimal(18,2)") * F.lit(Decimal("0.001"))).cast("decimal(18,5)").alias("spent"),
        )
        versions = scan(
            orders, ["user_id"], ["updated_at", "o_orderkey"],
            {"version": row_number(), "running": running_sum("spent")},
        )
        return versions.select(
            "user_id",
            "version",
            "updated_at",
            "user_status",
            loyalty_tier(F.col("running")).alias("user_tier"),
            F.col("running").cast("double").alias("total_spent"),
            F.concat(F.lit("user"), "user_id", F.lit("@mail.example")).alias("email"),
            (F.col("o_orderkey") % 97 == 0).alias("is_deleted"),
        )

    @property
    def product_changes(self) -> DataFrame:
        """Change log of products: three versions each, 800 days apart."""
        base = self.read("part").withColumn("version", F.explode(F.sequence(F.lit(0), F.lit(2))))
        price = (F.col("p_retailprice").cast("decimal(18,2)") * (1 + F.col("version") * 0.25).cast("decimal(4,2)")).cast(
            "decimal(18,2)"
        )
        share = F.when(F.col("p_size") % 17 == 0, 1.1).otherwise(0.7).cast("decimal(4,2)")
        return base.select(
            F.col("p_partkey").alias("product_id"),
            F.col("version").cast("long").alias("version"),
            F.expr("timestamp'1995-01-01 00:00:00' + make_dt_interval(version * 800)").alias("updated_at"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            price.cast("double").alias("price"),
            (price * share).cast("decimal(18,2)").cast("double").alias("cost"),
            ((F.col("p_size") * 7 + F.col("p_partkey") + F.col("version") * 31) % 120 - 3).cast("int").alias("inventory_count"),
            F.lit(20).alias("reorder_level"),
            F.when(F.col("p_partkey") % 10 == 0, "RETIRED").otherwise("ACTIVE").alias("product_status"),
            ((F.col("p_partkey") % 50 == 0) & (F.col("version") == 2)).alias("is_deleted"),
        )

    @property
    def purchases(self) -> DataFrame:
        """Distinct (user, product) purchase edges."""
        return self.sales("user_id", "product_id").distinct()

    @property
    def transfers(self) -> DataFrame:
        """Account transfers read from events: the user pays the account named in the event."""
        return self.events.filter("action = 'purchase'").select(
            F.col("event_id").alias("transfer_id"),
            F.col("user_id").alias("src"),
            F.col("product_id").alias("dst"),
            F.col("total_amount").alias("amount"),
            F.col("event_time").alias("sent_at"),
        )
