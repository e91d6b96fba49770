"""The registered queries, each over whole tables of one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell import fixed_values as fixed
from keepwell.functions.money import cents, from_cents
from keepwell.operators import dedup, mlprep, quality, ranking, sync
from keepwell.plans import actions, churn, customer360, kpis, ml, serving, silver
from keepwell.plans.medallion import GoldTables, refresh_gold
from keepwell.plans.registry import ModelRegistry
from keepwell.plans.tables import CustomerTables
from keepwell.session import fresh_path
from keepwell.sources import generate
from keepwell.sources.files import SharedFiles
from keepwell.sources.retail_inputs import AS_OF, RetailInputs
from keepwell.sources.served import ServedCopy
from keepwell.sources.tables import create_database, manifest, publish
from keepwell.streaming import ingest
from keepwell.streaming.incremental import CustomerState
from keepwell.streaming.refresh import Streamed, profile_from_silver, stream_to_silver

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


class Env(CustomerTables):
    """The tables of one folder."""

    inputs: RetailInputs

    def __init__(self, spark: SparkSession, folder: str, as_of: str = AS_OF, until: str | None = None):
        super().__init__(spark, RetailInputs(spark, folder, as_of, until))
        self.folder = folder

    def earlier(self, as_of: str) -> Env:
        """The state at the end of a day: only the rows up to it."""
        return Env(self.spark, self.folder, as_of, as_of)


def query(build: Callable[[Env], DataFrame]) -> Callable[[Env], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Env(spark, folder))

    QUERIES[build.__name__] = run
    return build


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Averages of doubles depend on summation order in the last bits."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


_DATABASES: dict[tuple, GoldTables] = {}


def _inputs_now(env: Env) -> tuple:
    """What is kept for a session is kept for these files: other sizes or times of change mean other input."""
    listing = SharedFiles(env.spark).listing(env.folder)
    return (env.spark.sparkContext.applicationId, env.folder, env.inputs.as_of, env.inputs.until, *listing)


def gold(env: Env, variant: str = "N") -> GoldTables:
    """The gold tables of a folder, refreshed once per session and state of the files into the shared folder."""
    key = (*_inputs_now(env), variant)
    if key not in _DATABASES:
        base = fresh_path(env.spark, "gold")
        if variant == "N":
            # two tables are computed from the facts, so these are conformed and stored once
            facts = env.stored_facts(f"{base}/facts")
            rollup = customer360.transaction_rollup_n(facts, env.products_n, env.as_of)
            profile = customer360.profile_n(env.customers_n, env.loyalty_n, rollup, env.as_of)
            partials = kpis.daily_partials(facts)
        else:
            profile, partials = env.profile_p, None
        _DATABASES[key] = refresh_gold(env.spark, _new_database(variant), base, profile, None, variant, partials)
        SharedFiles(env.spark).delete(f"{base}/facts")
    return _DATABASES[key]


def _new_database(variant: str) -> str:
    return f"retail_{variant.lower()}_{uuid.uuid4().hex[:12]}"


def features(env: Env, variant: str = "N") -> DataFrame:
    return gold(env, variant)["gold_customer_churn_features"]


# --- quality ----------------------------------------------------------------------
@query
def dq_expectation_report(env: Env) -> DataFrame:
    reports = [
        quality.report(silver.project_products_p(env.inputs.products()), quality.PRODUCT_RULES, "products"),
        quality.report(silver.project_customers_p(env.inputs.customers()), quality.CUSTOMER_RULES, "customers"),
        quality.report(env.inputs.dirty_loyalty().withColumn("loyalty_tier", F.initcap(F.trim("loyalty_tier"))),
                       quality.LOYALTY_RULES, "loyalty"),
        quality.report(silver.project_orders_p(env.inputs.dirty_orders()), quality.ORDER_RULES, "orders"),
        quality.report(silver.project_pos_p(env.inputs.pos()), quality.POS_RULES, "pos"),
    ]
    first, *rest = reports
    for other in rest:
        first = first.unionByName(other)
    return first


@query
def dq_expect_or_drop(env: Env) -> DataFrame:
    return quality.drop_violators(silver.project_orders_p(env.inputs.dirty_orders()), quality.ORDER_RULES)


@query
def dq_quarantine(env: Env) -> DataFrame:
    held = quality.quarantine(silver.project_orders_p(env.inputs.dirty_orders()), quality.ORDER_RULES)
    return held.withColumn("violations", F.concat_ws(",", "violations"))


@query
def dq_validity_summary(env: Env) -> DataFrame:
    return quality.validity_summary(env.customers_n, F.col("is_customer_record_valid"))


@query
def dq_null_counts(env: Env) -> DataFrame:
    return quality.null_counts(gold(env)["gold_customer_360"], ["customer_id", "total_revenue", "email", "loyalty_tier"])


@query
def dq_numeric_stats(env: Env) -> DataFrame:
    points = quality.numeric_stats(env.loyalty_n, "points_balance", F.sum("points_balance").cast("double"))
    price = quality.numeric_stats(
        env.products_n, "price", from_cents(F.sum(cents(F.col("price"))))
    )
    return points.unionByName(price)


@query
def table_row_counts(env: Env) -> DataFrame:
    return quality.row_counts(
        {
            "bronze_products": env.inputs.products(),
            "bronze_customers": env.inputs.customers(),
            "bronze_loyalty_profiles": env.inputs.loyalty(),
            "bronze_ecommerce_orders": env.inputs.orders(),
            "bronze_pos_transactions": env.inputs.pos(),
            "silver_transactions_unified": env.transactions,
            "silver_customers": env.customers_n,
            "silver_products": env.products_n,
        }
    )


@query
def mask_pii(env: Env) -> DataFrame:
    return quality.mask_contacts(env.customers_n.select("customer_id", "email", "phone"))


# --- silver -------------------------------------------------------------------------
@query
def dedup_latest_customers(env: Env) -> DataFrame:
    return dedup.latest_customers(env.inputs.customers())


@query
def dedup_latest_loyalty(env: Env) -> DataFrame:
    return dedup.latest_loyalty(env.inputs.loyalty())


@query
def dedup_first_products(env: Env) -> DataFrame:
    return dedup.first_products(env.inputs.products())


@query
def silver_customers(env: Env) -> DataFrame:
    return env.customers_n


@query
def silver_loyalty(env: Env) -> DataFrame:
    return env.loyalty_n


@query
def silver_products(env: Env) -> DataFrame:
    return env.products_n


@query
def silver_transactions_unified(env: Env) -> DataFrame:
    return env.transactions


@query
def silver_customer_identity(env: Env) -> DataFrame:
    return env.identity


@query
def silver_products_p(env: Env) -> DataFrame:
    return silver.silver_p("products", env.inputs.products())


@query
def silver_customers_p(env: Env) -> DataFrame:
    return silver.silver_p("customers", env.inputs.customers())


@query
def silver_loyalty_p(env: Env) -> DataFrame:
    return silver.silver_p("loyalty", env.inputs.loyalty())


@query
def silver_orders_p(env: Env) -> DataFrame:
    return silver.silver_p("orders", env.inputs.orders())


@query
def silver_pos_p(env: Env) -> DataFrame:
    return silver.silver_p("pos", env.inputs.pos())


@query
def customer_segment(env: Env) -> DataFrame:
    return env.identity.select("customer_id", "loyalty_tier", "customer_tenure_days", "customer_segment")


@query
def customer_tenure(env: Env) -> DataFrame:
    return env.customers_n.select("customer_id", "registration_date", "customer_tenure_days")


@query
def transactions_profile(env: Env) -> DataFrame:
    return silver.transactions_profile(env.transactions)


@query
def segment_distribution(env: Env) -> DataFrame:
    return silver.distribution(env.identity, "customer_segment").orderBy(F.desc("row_count"), "customer_segment")


@query
def tier_distribution(env: Env) -> DataFrame:
    return silver.distribution(env.loyalty_n, "loyalty_tier").orderBy("loyalty_tier")


@query
def category_distribution(env: Env) -> DataFrame:
    return silver.distribution(env.products_n, "category").orderBy(F.desc("row_count"), "category")


@query
def completed_revenue(env: Env) -> DataFrame:
    return kpis.completed_revenue(env.inputs.orders(), env.inputs.pos())


@query
def top_members_by_points(env: Env) -> DataFrame:
    chosen = env.identity.filter(F.col("customer_segment").isin("VIP", "High-Value"))
    return (
        chosen.select("customer_id", "full_name", "loyalty_tier", "points_balance", "customer_segment")
        .orderBy(F.desc("points_balance"), "customer_id")
        .limit(10)
    )


@query
def longest_tenure(env: Env) -> DataFrame:
    return (
        env.customers_n.select("customer_id", "full_name", "customer_tenure_days")
        .orderBy(F.desc("customer_tenure_days"), "customer_id")
        .limit(10)
    )


@query
def latest_transactions(env: Env) -> DataFrame:
    return (
        env.transactions.select("transaction_id", "customer_id", "channel", "transaction_timestamp", "gross_amount")
        .orderBy(F.desc("transaction_timestamp"), "transaction_id")
        .limit(10)
    )


@query
def loyalty_penetration(env: Env) -> DataFrame:
    return silver.loyalty_penetration(env.identity)


# --- customer 360 ---------------------------------------------------------------------
@query
def ecom_metrics(env: Env) -> DataFrame:
    return env.rollup_p.filter(F.col("ecom_orders") > 0).select(
        "customer_id", "ecom_orders", from_cents(F.col("ecom_cents")).alias("ecom_revenue")
    )


@query
def pos_metrics(env: Env) -> DataFrame:
    return env.rollup_p.filter(F.col("pos_orders") > 0).select(
        "customer_id", "pos_orders", from_cents(F.col("pos_cents")).alias("pos_revenue")
    )


@query
def refund_counts(env: Env) -> DataFrame:
    return env.rollup_p.filter(F.col("refund_return_count") > 0).select("customer_id", "refund_return_count")


@query
def purchase_dates(env: Env) -> DataFrame:
    return env.rollup_p.filter(F.col("ecom_orders") > 0).select(
        "customer_id", "first_purchase_date", "last_purchase_date"
    )


@query
def favorite_category_p(env: Env) -> DataFrame:
    return customer360.favorite_category_p(env.orders_p, env.products_p)


@query
def preferred_channel_p(env: Env) -> DataFrame:
    return customer360.preferred_channel_p(env.orders_p)


@query
def favorite_category_n(env: Env) -> DataFrame:
    return env.rollup_n.select("customer_id", "favorite_category")


@query
def preferred_channel_n(env: Env) -> DataFrame:
    rollup = customer360.transaction_rollup_n(env.transactions, None, env.as_of)
    return rollup.select("customer_id", "preferred_channel")


@query
def transaction_metrics_n(env: Env) -> DataFrame:
    rollup = customer360.transaction_rollup_n(env.transactions, None, env.as_of)
    return customer360.finish_metrics_n(rollup).select(
        "customer_id", "total_transactions", "completed_transactions", "total_revenue", "ecommerce_revenue",
        "instore_revenue", "avg_order_value", "first_purchase_date", "last_purchase_date",
        "refund_return_count", "days_since_last_purchase",
    )


@query
def gold_customer_360_n(env: Env) -> DataFrame:
    return env.c360_n


@query
def gold_customer_360_p(env: Env) -> DataFrame:
    return env.c360_p


# --- features and scores -----------------------------------------------------------------
_ACTIVITY = ("customer_id", "transactions_last_30d", "revenue_last_30d", "transactions_last_90d", "revenue_last_90d")


@query
def recent_activity_n(env: Env) -> DataFrame:
    rollup = customer360.transaction_rollup_n(env.transactions, None, env.as_of)
    return customer360.finish_metrics_n(rollup).select(*_ACTIVITY)


@query
def recent_activity_p(env: Env) -> DataFrame:
    return env.profile_p.select(*_ACTIVITY)


@query
def churn_features_n(env: Env) -> DataFrame:
    return env.features_n


@query
def churn_features_p(env: Env) -> DataFrame:
    return env.features_p


@query
def churn_label_n(env: Env) -> DataFrame:
    return env.features_n.select("customer_id", fixed.LABEL)


@query
def churn_label_noisy(env: Env) -> DataFrame:
    return env.profile_p.select(
        "customer_id",
        churn.label_p().alias("base_label"),
        churn.noisy(churn.label_p(), F.col("customer_id")).alias(fixed.LABEL),
    )


@query
def churn_scorecard_n(env: Env) -> DataFrame:
    return churn.add_score_card_n(env.features_n).select(
        "customer_id", "recency_score", "frequency_score", "refund_score", "loyalty_score", "churn_score"
    )


@query
def churn_scores_n(env: Env) -> DataFrame:
    return env.scores_n


@query
def churn_scores_p(env: Env) -> DataFrame:
    return env.scores_p


@query
def label_distribution(env: Env) -> DataFrame:
    return churn.label_distribution(features(env))


@query
def risk_band_distribution(env: Env) -> DataFrame:
    return churn.risk_band_distribution(gold(env)["gold_customer_churn_scores"])


@query
def top_risk_customers(env: Env) -> DataFrame:
    return churn.top_risk(gold(env)["gold_customer_churn_scores"])


# --- actions and KPIs -----------------------------------------------------------------------
@query
def next_best_actions_n(env: Env) -> DataFrame:
    return env.actions_n


@query
def next_best_actions_p(env: Env) -> DataFrame:
    return env.actions_p


@query
def campaign_volume(env: Env) -> DataFrame:
    return actions.campaign_volume(gold(env)["gold_next_best_actions"])


@query
def high_risk_sample(env: Env) -> DataFrame:
    return actions.high_risk_sample(gold(env)["gold_next_best_actions"])


@query
def executive_kpis(env: Env) -> DataFrame:
    return env.kpis


@query
def kpi_channel_summary(env: Env) -> DataFrame:
    return rounded(kpis.channel_summary(gold(env)["gold_executive_kpis"]), "avg_order_value", "avg_refund_rate")


@query
def kpi_overall(env: Env) -> DataFrame:
    return kpis.overall(gold(env)["gold_executive_kpis"], gold(env)["gold_daily_partials"])


@query
def kpi_distinct_customers(env: Env) -> DataFrame:
    """Customers counted once per channel and month, merged from the stored bitmaps."""
    monthly = gold(env)["gold_daily_partials"].withColumn("month", F.trunc("metric_date", "month"))
    return kpis.distinct_customers(monthly, "channel", "month")


@query
def latest_kpis(env: Env) -> DataFrame:
    return kpis.latest(gold(env)["gold_executive_kpis"])


# --- change feed and sync -----------------------------------------------------------------------
EARLIER_AS_OF = "2001-07-02"


_SYNCED = ("gold_customer_churn_scores", "gold_next_best_actions", "gold_customer_360")
_HISTORIES: dict[tuple, tuple[GoldTables, dict[str, ServedCopy]]] = {}


def _history(env: Env) -> tuple[GoldTables, dict[str, ServedCopy]]:
    """Gold tables refreshed on two days, and served copies synced after each: version 1 of all is the earlier day."""
    key = _inputs_now(env)
    if key not in _HISTORIES:
        base = fresh_path(env.spark, "history")
        database = _new_database("N")
        copies = {name: ServedCopy(env.spark, f"{base}/served/{name}", "customer_id") for name in _SYNCED}
        # today's refresh starts from today's stored profile; the rest of it are projections
        for profile in (env.earlier(EARLIER_AS_OF).profile_n, gold(env)["customer_profile"]):
            tables = refresh_gold(env.spark, database, base, profile, None, "N")
            for name, copy in copies.items():
                tables.sync(name, copy)
        _HISTORIES[key] = tables, copies
    return _HISTORIES[key]


@query
def cdc_snapshot_diff(env: Env) -> DataFrame:
    """The changes of one table between two refreshes, from its versions."""
    return _history(env)[0].feed("gold_customer_churn_scores", 1, 2)


@query
def sync_upsert_merge(env: Env) -> DataFrame:
    """The stored serving copy, made on the earlier day and brought up to date with the change feed."""
    return _history(env)[1]["gold_customer_churn_scores"].read()


@query
def sync_verify(env: Env) -> DataFrame:
    """Stored gold against the copies as they were before the second sync, and against one that is up to date."""
    tables, copies = _history(env)
    pairs = [(name, tables[name], copies[name].read(1)) for name in _SYNCED]
    name = _SYNCED[0]
    return sync.sync_checks([*pairs, (f"{name} after sync", tables[name], copies[name].read())])


@query
def current_scores(env: Env) -> DataFrame:
    """Model scores for customers with a purchase, rule scores for the others."""
    bought = env.features_n.filter(F.col("days_since_last_purchase") < fixed.NEVER_PURCHASED_DAYS)
    return churn.current_scores(churn.scores_from_probability(bought, recency_probability()), env.scores_n)


@query
def write_roundtrip_overwrite(env: Env) -> DataFrame:
    """Publish twice; the second overwrite reads the table it replaces."""
    name, base = f"roundtrip_{uuid.uuid4().hex[:12]}", fresh_path(env.spark, "roundtrip")
    first = publish(env.kpis, name, base)
    return publish(first.filter(F.col("channel") == fixed.ECOMMERCE), name, base)


@query
def write_schema_replace(env: Env) -> DataFrame:
    name, base = f"replaced_{uuid.uuid4().hex[:12]}", fresh_path(env.spark, "replaced")
    first = publish(env.scores_n, name, base)
    return publish(
        first.select("customer_id", F.col("churn_score").cast("double").alias("churn_score"), "churn_risk_band"),
        name,
        base,
    )


@query
def table_manifest(env: Env) -> DataFrame:
    tables = gold(env)
    return manifest(env.spark, tables.database, sync.matching_tables(env.spark, [""], tables.database))


@query
def describe_table(env: Env) -> DataFrame:
    return sync.describe(gold(env)["gold_customer_360"], "gold_customer_360")


@query
def discover_tables(env: Env) -> DataFrame:
    tables = gold(env)
    found = sync.matching_tables(env.spark, ["synced", "churn", "customer_3", "next_best"], tables.database)
    return quality.row_counts({name: tables[name] for name in found})


# --- serving --------------------------------------------------------------------------------------
@query
def serve_risk_distribution(env: Env) -> DataFrame:
    return serving.risk_distribution(gold(env)["gold_customer_churn_scores"])


@query
def serve_loyalty_distribution(env: Env) -> DataFrame:
    return serving.loyalty_distribution(gold(env)["gold_customer_360"])


@query
def serve_top_high_risk(env: Env) -> DataFrame:
    return serving.top_high_risk(gold(env)["gold_customer_churn_scores"])


@query
def serve_customer_search(env: Env) -> DataFrame:
    tables = gold(env)
    return serving.customer_search(tables["gold_customer_churn_scores"], tables["gold_customer_360"], " 12 ")


@query
def serve_customer_detail(env: Env) -> DataFrame:
    tables = gold(env)
    return serving.customer_detail(
        tables["gold_customer_churn_scores"], tables["gold_customer_360"], tables["gold_next_best_actions"], 42
    )


@query
def serve_nba_sample(env: Env) -> DataFrame:
    return serving.nba_sample(gold(env)["gold_next_best_actions"])


# --- streaming --------------------------------------------------------------------------------------
def _arrivals(
    env: Env, datasets: dict[str, DataFrame], base: str, restart: bool, lines: str | None = None
) -> Iterator[dict[str, Streamed]]:
    """Land each frame as JSON and stream it to silver; with restart, half of the rows arrive later.

    Landed files are deleted when bronze and silver hold their rows, and the stored `lines` that frames scan when all have landed.
    """
    landing = {dataset: f"{base}/landing/{dataset}" for dataset in datasets}
    files = SharedFiles(env.spark)
    for late in (0, 1) if restart else (None,):
        for dataset, rows in datasets.items():
            half = F.pmod(F.xxhash64(*rows.columns), F.lit(2))
            ingest.write_landing(rows if late is None else rows.filter(half == late), landing[dataset])
        if lines and late != 0:
            files.delete(lines)
        folders = stream_to_silver(env.spark, landing, f"{base}/tables")
        for folder in landing.values():
            files.delete(folder)
        yield folders


def _streamed(env: Env, datasets: dict[str, DataFrame], restart: bool, lines: str | None = None) -> dict[str, Streamed]:
    """The tables after the last arrival."""
    return list(_arrivals(env, datasets, fresh_path(env.spark, "stream"), restart, lines))[-1]


@query
def ingest_stream_products(env: Env) -> DataFrame:
    folders = _streamed(env, {"products": env.inputs.products()}, restart=True)
    return folders["products"].silver.read()


@query
def ingest_stream_transactions(env: Env) -> DataFrame:
    """Both channels streamed to silver, then conformed by the batch step over the streamed tables."""
    inputs = env.inputs.stored(fresh_path(env.spark, "lines"))
    folders = _streamed(env, {"orders": inputs.orders(), "pos": inputs.pos()}, restart=False)
    return silver.transactions_unified(
        folders["orders"].silver.read(), folders["pos"].silver.read()
    )


@query
def stream_silver_orders(env: Env) -> DataFrame:
    inputs = env.inputs.stored(fresh_path(env.spark, "lines"))
    folders = _streamed(env, {"orders": inputs.dirty_orders()}, restart=True)
    return folders["orders"].silver.read()


@query
def stream_unique_orders(env: Env) -> DataFrame:
    """Orders that land twice, in two runs; the stream's state lets each reach silver once."""
    base = fresh_path(env.spark, "stream-unique")
    orders, half = env.inputs.stored(f"{base}/lines").orders(), F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    unique = ingest.Unique("order_id", "order_date", "4000 days")  # longer than the history: no row is late
    for arrived in (orders.filter(half), orders):
        ingest.write_landing(arrived, f"{base}/landing")
        ingest.ingest(env.spark, f"{base}/landing", f"{base}/bronze", f"{base}/c1", ingest.LANDING["orders"])
        kept = ingest.refine(env.spark, "orders", f"{base}/bronze", f"{base}/silver", f"{base}/c2", unique=unique)
    return kept.read()


@query
def streamed_gold_360_p(env: Env) -> DataFrame:
    """All five sources streamed, then customer 360 over the streamed tables."""
    inputs = env.inputs.stored(fresh_path(env.spark, "lines"))
    sources = {
        "products": env.inputs.products(),
        "customers": env.inputs.customers(),
        "loyalty": env.inputs.loyalty(),
        "orders": inputs.orders(),
        "pos": inputs.pos(),
    }
    return customer360.customer_360_p(
        profile_from_silver(_streamed(env, sources, restart=False, lines=inputs.kept), env.as_of)
    )


@query
def incremental_gold_360_p(env: Env) -> DataFrame:
    """Customer 360 from state that two arrivals of all five sources have moved on, folded after the first."""
    base = fresh_path(env.spark, "incremental")
    inputs = env.inputs.stored(f"{base}/lines")
    sources = {
        "products": env.inputs.products(),
        "customers": env.inputs.customers(),
        "loyalty": env.inputs.loyalty(),
        "orders": inputs.orders(),
        "pos": inputs.pos(),
    }
    state = CustomerState(env.spark, f"{base}/state")
    for arrival, streamed in enumerate(_arrivals(env, sources, base, restart=True, lines=inputs.kept)):
        state.advance({dataset: streamed[dataset].silver for dataset in ("orders", "pos")})
        if not arrival:
            state.compact()
    tables = {dataset: streamed[dataset].silver.read() for dataset in ("products", "customers", "loyalty")}
    rollup = state.rollup(dedup.first_products(tables["products"]), env.as_of)
    customers, loyalty = dedup.latest_customers(tables["customers"]), dedup.latest_loyalty(tables["loyalty"])
    return customer360.customer_360_p(customer360.profile_p(customers, loyalty, rollup, env.as_of))


@query
def stream_quality_report(env: Env) -> DataFrame:
    """Violations of every rule of the five datasets, counted while their rows stream to silver."""
    inputs = env.inputs.stored(fresh_path(env.spark, "lines"))
    sources = {
        "products": env.inputs.products(),
        "customers": env.inputs.customers(),
        "loyalty": env.inputs.dirty_loyalty().withColumn("loyalty_tier", F.initcap(F.trim("loyalty_tier"))),
        "orders": inputs.dirty_orders(),
        "pos": inputs.pos(),
    }
    reports = [
        ingest.violation_rows(env.spark, dataset, tables.silver.totals(), silver.SILVER_P[dataset][1])
        for dataset, tables in _streamed(env, sources, restart=True, lines=inputs.kept).items()
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def stream_landing_report(env: Env) -> DataFrame:
    """Rows that landed and rows rescued, of orders whose customer ids are text and some of whose amounts are."""
    base = fresh_path(env.spark, "stream-odd")
    orders = env.inputs.stored(f"{base}/lines").orders()
    number = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("long")
    odd = orders.withColumn("customer_id", F.concat(F.lit("CUST"), F.lpad(F.col("customer_id").cast("string"), 6, "0")))
    faulty = number % 29 == 0
    ingest.write_landing(odd.filter(~faulty), f"{base}/landing/orders")
    ingest.write_landing(odd.filter(faulty).withColumn("order_amount", F.lit("n/a")), f"{base}/landing/orders")
    streamed = stream_to_silver(env.spark, {"orders": f"{base}/landing/orders"}, base)["orders"]
    totals = streamed.bronze.totals()
    text_ids = streamed.bronze.read().filter(F.col("customer_id").startswith("CUST"))
    return text_ids.agg(
        F.count(F.lit(1)).alias("rows_with_text_id"), F.lit(totals["rows"]).alias("rows"), F.lit(totals["rescued"]).alias("rescued")
    )


# --- generated rows: one per key of a supplied table -----------------------------------------------------
@query
def gen_products(env: Env) -> DataFrame:
    return generate.products(env.inputs.table("part"), "p_partkey")


@query
def gen_customers(env: Env) -> DataFrame:
    return generate.customers(env.inputs.table("customer"), env.as_of, "c_custkey")


@query
def gen_loyalty(env: Env) -> DataFrame:
    ids = env.inputs.table("customer")
    return generate.loyalty(ids, env.as_of, ids.count(), "c_custkey")


@query
def gen_orders(env: Env) -> DataFrame:
    sizes = [env.inputs.table(name).count() for name in ("customer", "part")]
    return generate.orders(env.inputs.table("orders"), env.as_of, *sizes, key="o_orderkey")


@query
def gen_pos(env: Env) -> DataFrame:
    sizes = [env.inputs.table(name).count() for name in ("customer", "part")]
    return generate.pos(env.inputs.table("orders"), env.as_of, *sizes, key="o_orderkey")


# --- machine learning -------------------------------------------------------------------------------------
_NUMERIC_AND_LABEL = [*fixed.NUMERIC_FEATURES, fixed.LABEL]


def recency_probability() -> Column:
    """A churn probability any engine can compute: recency against a 90-day half-way point."""
    days = F.greatest(F.col("days_since_last_purchase"), F.lit(0)).cast("double")
    return days / (days + 90.0)


@query
def profile_features(env: Env) -> DataFrame:
    return rounded(mlprep.profile(features(env), _NUMERIC_AND_LABEL), "mean", "stddev", "q1", "median", "q3")


@query
def class_balance(env: Env) -> DataFrame:
    return mlprep.class_balance(features(env, "P"))


@query
def class_weights(env: Env) -> DataFrame:
    return mlprep.class_balance(features(env, "P")).select(fixed.LABEL, "class_weight")


@query
def feature_correlations(env: Env) -> DataFrame:
    return rounded(mlprep.correlations(features(env), _NUMERIC_AND_LABEL), "correlation")


@query
def label_feature_ranking(env: Env) -> DataFrame:
    return rounded(mlprep.label_correlations(features(env, "P"), fixed.NUMERIC_FEATURES), "abs_correlation")


@query
def feature_quantiles_by_label(env: Env) -> DataFrame:
    return rounded(
        mlprep.quantiles_by_label(features(env), fixed.BOX_PLOT_FEATURES), "min", "q1", "median", "q3", "max"
    )


@query
def ml_prepared(env: Env) -> DataFrame:
    return mlprep.fill_categories(features(env))


@query
def one_hot_features(env: Env) -> DataFrame:
    prepared = mlprep.fill_categories(features(env)).select("customer_id", *fixed.CATEGORICAL_FEATURES)
    levels = mlprep.category_levels(prepared, fixed.CATEGORICAL_FEATURES)
    return mlprep.one_hot(prepared, levels)


def _split_n(env: Env) -> DataFrame:
    return ranking.stratified_split(
        features(env), fixed.LABEL, "customer_id", fixed.SPLIT_SHARES, fixed.SPLIT_SEED
    )


@query
def stratified_split(env: Env) -> DataFrame:
    return _split_n(env).select("customer_id", fixed.LABEL, "split")


@query
def imputed_features(env: Env) -> DataFrame:
    split = _split_n(env).select("customer_id", "split", *fixed.NUMERIC_FEATURES)
    medians = mlprep.fitted_medians(split.filter(F.col("split") == "train"), fixed.NUMERIC_FEATURES)
    return mlprep.impute(split, medians)


@query
def scaled_features(env: Env) -> DataFrame:
    split = _split_n(env).select("customer_id", "split", *fixed.NUMERIC_FEATURES)
    scales = mlprep.fitted_scales(split.filter(F.col("split") == "train"), fixed.NUMERIC_FEATURES)
    return rounded(mlprep.scale(split, scales), *fixed.NUMERIC_FEATURES)


def _rule_predictions(env: Env) -> DataFrame:
    """Noisy label, rule prediction (band High) and the recency probability, from one profile."""
    scored = churn.add_scores_p(churn.add_features_p(gold(env, "P")["customer_profile"]))
    return scored.select(
        "customer_id",
        fixed.LABEL,
        "churn_score",
        "churn_risk_band",
        (F.col("churn_risk_band") == "High").cast("int").alias("rule_prediction"),
        recency_probability().alias("ml_churn_probability"),
        (recency_probability() >= 0.5).cast("int").alias("ml_prediction"),
    )


@query
def binary_metrics(env: Env) -> DataFrame:
    return mlprep.binary_metrics(_rule_predictions(env), fixed.LABEL, "rule_prediction")


@query
def roc_auc_rank(env: Env) -> DataFrame:
    return rounded(ranking.rank_auc(_rule_predictions(env), "ml_churn_probability", fixed.LABEL), "roc_auc")


@query
def ml_vs_rules(env: Env) -> DataFrame:
    return mlprep.compare_predictions(_rule_predictions(env), fixed.LABEL, "ml_prediction", "rule_prediction")


@query
def ml_vs_rules_disagreements(env: Env) -> DataFrame:
    chosen = mlprep.top_disagreements(
        _rule_predictions(env), "ml_prediction", "rule_prediction", "ml_churn_probability"
    )
    return chosen.select("customer_id", fixed.LABEL, "ml_churn_probability", "churn_score", "churn_risk_band")


@query
def deploy_reasons(env: Env) -> DataFrame:
    return churn.add_reasons_ml(features(env)).select("customer_id", "top_reason_1", "top_reason_2")


@query
def deploy_scores(env: Env) -> DataFrame:
    return churn.scores_from_probability(features(env), recency_probability())


@query
def deploy_summary(env: Env) -> DataFrame:
    return churn.risk_band_distribution(churn.scores_from_probability(features(env), recency_probability()))


# trained once per folder and session, on the stored features with the noisy label
_TRAINED: dict[tuple, dict[str, ml.Trained]] = {}
_PREPARED: dict[tuple, tuple] = {}


def _training_set(env: Env) -> tuple:
    key = _inputs_now(env)
    if key not in _PREPARED:
        base = fresh_path(env.spark, "models")
        ml.split_frame(features(env, "P")).write.parquet(f"{base}/split")
        split = env.spark.read.parquet(f"{base}/split")
        train = ml.with_weights(split.filter(F.col("split") == "train"))
        _PREPARED[key] = (base, split, train, train.count(), ml.fit_preparation(train))
    return _PREPARED[key]


def _all_trained(env: Env, names: Sequence[str]) -> dict[str, ml.Trained]:
    models = _TRAINED.setdefault(_inputs_now(env), {})
    missing = [name for name in names if name not in models]
    if missing:
        base, split, train, rows, prepared = _training_set(env)
        for trained in ml.train_candidates(missing, prepared, split, train, rows, base):
            ml.run_record(trained).write.mode("append").parquet(f"{base}/runs")
            models[trained.name] = trained
    return models


def _trained(env: Env, name: str) -> ml.Trained:
    return _all_trained(env, [name])[name]


def _all_runs(env: Env) -> DataFrame:
    _all_trained(env, list(ml.CANDIDATES))
    return env.spark.read.parquet(f"{_training_set(env)[0]}/runs")


def _best(env: Env) -> ml.Trained:
    return _trained(env, ml.leaderboard(_all_runs(env)).first().model)


@query
def ml_train_lr(env: Env) -> DataFrame:
    return _trained(env, "logistic_regression").metrics


@query
def ml_train_rf(env: Env) -> DataFrame:
    return _trained(env, "random_forest").metrics


@query
def ml_train_gbt(env: Env) -> DataFrame:
    return _trained(env, "gradient_boosting").metrics


@query
def ml_train_gbt_weighted(env: Env) -> DataFrame:
    return _trained(env, "gradient_boosting_weighted").metrics


@query
def model_runs(env: Env) -> DataFrame:
    return _all_runs(env)


@query
def model_leaderboard(env: Env) -> DataFrame:
    return ml.leaderboard(_all_runs(env))


@query
def feature_importance(env: Env) -> DataFrame:
    return ml.feature_importance(_best(env).model, _training_set(env)[1])


@query
def ml_predictions(env: Env) -> DataFrame:
    return _best(env).predictions


@query
def ml_vs_rules_trained(env: Env) -> DataFrame:
    """The trained model against the rules, per split: the train rows are labelled, not mixed in."""
    rules = gold(env, "P")["gold_customer_churn_scores"].select(
        "customer_id", (F.col("churn_risk_band") == "High").cast("int").alias("rule_prediction")
    )
    joined = _best(env).predictions.join(rules, "customer_id")
    return mlprep.compare_predictions(joined, fixed.LABEL, "ml_prediction", "rule_prediction", ["split"])


_REGISTRIES: dict[tuple, ModelRegistry] = {}


def _registry(env: Env) -> ModelRegistry:
    """All candidates registered, the scores of the best one deployed."""
    key = _inputs_now(env)
    if key not in _REGISTRIES:
        base, split, *_ = _training_set(env)
        database = _new_database("P")
        create_database(env.spark, database)
        registry = ModelRegistry(env.spark, f"{base}/registry", f"{database}.deployed_churn_scores")
        chosen = ml.leaderboard(_all_runs(env)).collect()
        for row in chosen:
            figures = {k: float(v) for k, v in row.asDict().items() if k != "model" and v is not None}
            registry.register(row.model, _trained(env, row.model).path, figures)
        run = registry.best("validation_f1")
        rows = features(env, "P")
        predicted = ml.predict(registry.model(run), ml.model_frame(rows)).select("customer_id", "ml_churn_probability")
        scores = churn.scores_from_probability(rows.join(predicted, "customer_id"), F.col("ml_churn_probability"))
        registry.deploy(run, scores, rows)
        _REGISTRIES[key] = registry
    return _REGISTRIES[key]


@query
def deploy_scores_trained(env: Env) -> DataFrame:
    """The published scores of the registered model that is deployed."""
    return _registry(env).scores()


@query
def deploy_runs(env: Env) -> DataFrame:
    """Registered runs, and which one is deployed in which version of the scores."""
    registry = _registry(env)
    now = registry.current()
    deployed = F.col("run") == now["run"]
    return registry.runs().select("run", "model", "metrics", F.when(deployed, now["version"]).alias("deployed_version"))


@query
def current_scores_trained(env: Env) -> DataFrame:
    """Deployed model scores for customers with a purchase, rule scores for the others."""
    bought = features(env, "P").filter(F.col("days_since_last_purchase") < fixed.NEVER_PURCHASED_DAYS)
    deployed = _registry(env).scores().join(bought.select("customer_id"), "customer_id", "left_semi")
    return churn.current_scores(deployed, gold(env, "P")["gold_customer_churn_scores"])
