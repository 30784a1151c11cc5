"""Scans, projections, joins, aggregates, windows and checks as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder import schemas
from larder.functions import scalars as S
from larder.operators import aggregates as A
from larder.operators import cooccurrence as C
from larder.operators import graph as G
from larder.operators import joins as J
from larder.operators import ledger as L
from larder.operators import quality as Q
from larder.operators import sessions as SE
from larder.plans.registry import query
from larder.plans.views import SCORE, SHELF, with_views
from larder.session import scratch_path
from larder.sources import bindings as B
from larder.sources import tables as T

MOVEMENT_COLS = (
    "row_id, event_id, household_id, stock_id, product_id, product_name, event_type, quantity, timestamp, "
    "expiry_date, classification"
)


def inventory(spark: SparkSession, d: str) -> DataFrame:
    return J.enrich(B.movements(spark, d), B.catalog(spark, d))


def big(df: DataFrame) -> DataFrame:
    """Integers of any width as 64-bit, so that the result schema does not depend on the engine."""
    return df.select(
        *[F.col(f.name).cast("bigint") if f.dataType.typeName() in ("integer", "short", "byte") else F.col(f.name)
          for f in df.schema.fields]
    )


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


# --- flagship ------------------------------------------------------------------------------------------------------


@query(
    "waste_by_category_score",
    with_views(
        "inventory",
        """SELECT CAST(category AS BIGINT) AS category, nutriscore,
             CAST(coalesce(sum(quantity) FILTER (WHERE event_type = 'IN'), 0) AS BIGINT) AS in_qty,
             CAST(coalesce(sum(quantity) FILTER (WHERE classification IN ('Waste', 'Forced_Waste')), 0) AS BIGINT)
               AS waste_qty,
             round(CASE WHEN coalesce(sum(quantity) FILTER (WHERE event_type = 'IN'), 0) > 0 THEN
               CAST(coalesce(sum(quantity) FILTER (WHERE classification IN ('Waste', 'Forced_Waste')), 0) AS DOUBLE)
               / sum(quantity) FILTER (WHERE event_type = 'IN') END, 6) AS waste_rate
           FROM inventory GROUP BY category, nutriscore""",
    ),
)
def waste_by_category_score(spark, d):
    return rounded(big(A.waste_rate(inventory(spark, d), "category", "nutriscore")), 6, "waste_rate")


# --- scans, sources, sinks -----------------------------------------------------------------------------------------


@query("scan_movements", with_views("movements", f"SELECT {MOVEMENT_COLS} FROM movements"))
def scan_movements(spark, d):
    return big(B.movements(spark, d))


@query("scan_limit", "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM (SELECT * FROM events LIMIT 10)")
def scan_limit(spark, d):
    events = B.table(spark, d, "events")
    return T.head(events, 10).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(events.columns)).cast("bigint").alias("n_cols")
    )


def _patterns_document(spark: SparkSession, d: str) -> DataFrame:
    hours = A.frequency_shares(
        B.movements(spark, d).select(F.hour("timestamp").cast("string").alias("hour")), "hour"
    )
    ids = A.top_k(B.baskets(spark, d), "item", 50).select(F.col("item").alias("product_id"))
    products = J.keep_listed(B.products(spark, d), ids, "product_id").select(
        "product_id", "product_name", "department_id"
    )
    # 24 hours at most and 50 products: both sides fit one record.
    hour_map = hours.agg(F.map_from_entries(F.collect_list(F.struct("hour", "share"))).alias("distribucion_horas"))
    top = products.agg(
        F.sort_array(F.collect_list(F.struct("product_id", "product_name", "department_id"))).alias("top_50_productos")
    )
    return hour_map.select("distribucion_horas", top.scalar().alias("top_50_productos"))


TOP_ITEMS = "SELECT l_partkey FROM lineitem GROUP BY l_partkey ORDER BY count(*) DESC, l_partkey LIMIT 50"


@query(
    "patterns_document",
    with_views(
        "products",
        f"""SELECT 'hour' AS section, CAST(hour(ts) AS VARCHAR) AS key, NULL AS label,
             round_even(count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE), 4) AS number FROM events GROUP BY 2
           UNION ALL SELECT 'product', CAST(product_id AS VARCHAR), product_name, CAST(department_id AS DOUBLE) FROM products
           WHERE product_id IN ({TOP_ITEMS})""",
    ),
)
def patterns_document(spark, d):
    """The document as JSON text, parsed again into its entries."""
    text = _patterns_document(spark, d).select(F.to_json(F.struct("*")).alias("document"))
    doc = text.select(F.from_json("document", schemas.PATTERNS).alias("doc")).select("doc.*")
    hours = doc.select(F.explode("distribucion_horas").alias("key", "number")).select(F.lit("hour").alias("section"), "key", F.lit(None).cast("string").alias("label"), "number")
    products = doc.select(F.inline("top_50_productos")).select(
        F.lit("product").alias("section"), F.col("product_id").cast("string").alias("key"), F.col("product_name").alias("label"), F.col("department_id").cast("double").alias("number")
    )
    return hours.unionByName(products)


def _patterns_round_trip(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "patterns")
    T.write_json(_patterns_document(spark, d), path)
    return T.read_patterns(spark, path)


HOUR_SHARES = (
    "SELECT CAST(hour(ts) AS {0}) AS hour, round_even(count(*) / CAST((SELECT count(*) FROM events) AS DOUBLE), 4) "
    "AS share FROM events GROUP BY 1"
)


@query("patterns_hours", HOUR_SHARES.format("VARCHAR"))
def patterns_hours(spark, d):
    return _patterns_round_trip(spark, d)[0]



@query(
    "patterns_products",
    with_views(
        "products",
        f"""SELECT product_id, product_name, CAST(department_id AS BIGINT) AS department_id FROM products
            WHERE product_id IN ({TOP_ITEMS})""",
    ),
)
def patterns_products(spark, d):
    return big(_patterns_round_trip(spark, d)[1])


INVENTORY_COLS = MOVEMENT_COLS + ", nutriscore, calories_100g, proteins_100g, carbs_100g, category"
INVENTORY_SELECT = INVENTORY_COLS.replace(", category", ", CAST(category AS BIGINT) AS category")


@query("roundtrip_inventory", with_views("inventory", f"SELECT {INVENTORY_SELECT} FROM inventory"))
def roundtrip_inventory(spark, d):
    path = scratch_path(spark, "inventory")
    T.write_parquet(inventory(spark, d), path)
    return big(T.read_parquet(spark, path))


@query(
    "roundtrip_csv",
    with_views(
        "movements",
        """SELECT event_id, household_id, stock_id, product_id, product_name, event_type, quantity,
             date_trunc('second', timestamp) AS timestamp, expiry_date, classification FROM movements""",
    ),
)
def roundtrip_csv(spark, d):
    path = scratch_path(spark, "movements")
    log = B.movements(spark, d).select(*schemas.MOVEMENTS.fieldNames())
    T.write_csv(log.withColumn("timestamp", F.date_trunc("second", "timestamp").cast("timestamp_ntz")), path)
    return big(T.read_csv(spark, path, schemas.MOVEMENTS))


# --- projections, scalars ------------------------------------------------------------------------------------------


@query(
    "catalog_subset",
    with_views(
        "catalog",
        """SELECT product_id, nutriscore, calories_100g, proteins_100g, carbs_100g, CAST(category AS BIGINT) AS category
           FROM catalog""",
    ),
)
def catalog_subset(spark, d):
    return big(J.catalog_subset(B.catalog(spark, d)))


@query(
    "cast_keys",
    "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS product_id FROM events",
)
def cast_keys(spark, d):
    raw = B.table(spark, d, "events").select(
        "event_id", F.regexp_extract("props", "([0-9]+)", 1).alias("product_id")
    )
    return J.cast_key(raw)


@query(
    "normalize_name",
    """SELECT p_partkey, trim(replace(CASE WHEN p_partkey % 3 = 0 THEN 'Organic ' || p_name || ' Organic'
         WHEN p_partkey % 3 = 1 THEN replace(p_name, ' ', ' Organic ') ELSE '  organic ' || p_name || '  ' END,
         'Organic', '')) AS search_name FROM part""",
)
def normalize_name(spark, d):
    key, name = F.col("p_partkey"), F.col("p_name")
    raw = (
        F.when(key % 3 == 0, F.concat(F.lit("Organic "), name, F.lit(" Organic")))
        .when(key % 3 == 1, F.replace(name, F.lit(" "), F.lit(" Organic ")))
        .otherwise(F.concat(F.lit("  organic "), name, F.lit("  ")))
    )
    return B.table(spark, d, "part").select("p_partkey", S.search_name(raw).alias("search_name"))


@query(
    "lookup_default",
    with_views(
        "products",
        f"""SELECT product_id, CAST(department_id AS BIGINT) AS department_id,
              CAST({SHELF.format('department_id')} AS BIGINT) AS shelf_life FROM products""",
    ),
)
def lookup_default(spark, d):
    p = B.products(spark, d)
    return big(p.select("product_id", "department_id", S.shelf_life(F.col("department_id")).alias("shelf_life")))


@query(
    "hour_share",
    with_views(
        "movements",
        """WITH h AS (SELECT row_id, event_type, CAST(hour(timestamp) AS BIGINT) AS hour FROM movements),
          n AS (SELECT hour, count(*) AS n FROM h WHERE event_type = 'IN' AND hour % 5 <> 0 GROUP BY 1),
          s AS (SELECT hour, round_even(n / CAST(sum(n) OVER () AS DOUBLE), 4) AS share FROM n)
          SELECT row_id, h.hour, coalesce(share, 0.05e0) AS share FROM h LEFT JOIN s USING (hour)""",
    ),
)
def hour_share(spark, d):
    """The share of each movement's hour in a distribution that lists only some hours."""
    hours = B.movements(spark, d).select("row_id", "event_type", S.hour_of_day(F.col("timestamp")).cast("bigint").alias("hour"))
    listed = A.frequency_shares(hours.filter("event_type = 'IN' AND hour % 5 <> 0"), "hour")
    shares = {r["hour"]: r["share"] for r in listed.collect()}  # 24 rows at most
    return hours.select("row_id", "hour", S.hour_share(F.col("hour"), shares).alias("share"))


@query(
    "map_values",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'teal' WHEN 'purchase' THEN 'amber' END AS color
       FROM events""",
)
def map_values(spark, d):
    colors = {"click": "teal", "purchase": "amber"}
    return B.table(spark, d, "events").select(
        "event_id", S.lookup_constant(F.col("event_type"), colors).alias("color")
    )


@query(
    "nutriscore",
    with_views("catalog", "SELECT product_id, calories_100g, nutriscore FROM catalog"),
)
def nutriscore(spark, d):
    c = B.catalog(spark, d)
    return c.select("product_id", "calories_100g", S.nutriscore(F.col("calories_100g")).alias("nutriscore"))


@query(
    "fill_defaults",
    with_views(
        "inventory",
        """SELECT row_id, coalesce(calories_100g, 0) AS calories_100g, coalesce(proteins_100g, 0) AS proteins_100g,
             coalesce(product_name, '') AS product_name, coalesce(nutriscore, 'Falta Dato') AS nutriscore
           FROM inventory""",
    ),
)
def fill_defaults(spark, d):
    filled = inventory(spark, d).na.fill(
        {"calories_100g": 0.0, "proteins_100g": 0.0, "product_name": "", "nutriscore": S.MISSING_SCORE}
    )
    return filled.select("row_id", "calories_100g", "proteins_100g", "product_name", "nutriscore")


@query(
    "out_indicator",
    with_views(
        "movements",
        "SELECT row_id, CAST(CASE WHEN event_type = 'OUT' THEN 1 ELSE 0 END AS BIGINT) AS target FROM movements",
    ),
)
def out_indicator(spark, d):
    return big(B.movements(spark, d).select("row_id", S.out_indicator(F.col("event_type")).alias("target")))


@query(
    "time_parts",
    """SELECT event_id, date_trunc('second', ts) AS parsed, CAST(hour(ts) AS BIGINT) AS hour_of_day,
         CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week FROM events""",
)
def time_parts(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = B.table(spark, d, "events").select("event_id", S.parse_timestamp(text).alias("parsed"))
    ts = F.col("parsed")
    return big(
        parsed.select("event_id", ts, S.hour_of_day(ts).alias("hour_of_day"), S.day_of_week(ts).alias("day_of_week"))
    )


@query(
    "expiry_date",
    with_views(
        "inventory",
        f"""SELECT row_id, day + CAST({SHELF.format('category')} AS INTEGER) AS expiry_date,
              day + CAST({SHELF.format('category')} + 3 AS INTEGER) AS writeoff_day, day - 90 AS window_start
            FROM inventory""",
    ),
)
def expiry_date(spark, d):
    day = F.to_date("timestamp")
    dated = inventory(spark, d).withColumn("expiry_date", S.expiry_date(day, F.col("category")))
    return dated.select(
        "row_id",
        "expiry_date",
        S.writeoff_day(F.col("expiry_date")).alias("writeoff_day"),
        F.date_sub(day, 90).alias("window_start"),
    )


@query(
    "format_ts",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y-%m-%d') AS day_text,
         date_trunc('day', ts) + INTERVAL '23 hours 59 minutes 59 seconds' AS day_end,
         date_trunc('day', ts) + to_hours(CAST(event_id % 24 AS INTEGER)) + to_minutes(CAST(event_id % 60 AS INTEGER))
           AS replaced FROM events""",
)
def format_ts(spark, d):
    day = F.to_date("ts")
    ymd = [F.year(day), F.month(day), F.dayofmonth(day)]
    clock = [(F.col("event_id") % 24).cast("int"), (F.col("event_id") % 60).cast("int"), F.lit(0)]
    return B.table(spark, d, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        S.end_of_day(day).alias("day_end"),
        F.make_timestamp_ntz(*ymd, *clock).alias("replaced"),
    )


@query("classify_movement", with_views("movements", "SELECT row_id, classification FROM movements"))
def classify_movement(spark, d):
    m = B.movements(spark, d)
    label = S.classify_movement(F.col("event_type"), F.to_date("timestamp"), F.col("expiry_date"))
    return m.select("row_id", label.alias("classification"))


@query(
    "surrogate_key",
    with_views(
        "movements",
        """SELECT row_id, substring(sha256(household_id || '|' || stock_id || '|' || row_id), 1, 16) AS event_key,
             substring(sha256(household_id || '|' || stock_id), 1, 8) AS lot_key FROM movements""",
    ),
)
def surrogate_key(spark, d):
    return B.movements(spark, d).select(
        "row_id",
        S.surrogate_key(F.col("household_id"), F.col("stock_id"), F.col("row_id")).alias("event_key"),
        S.surrogate_key(F.col("household_id"), F.col("stock_id"), length=8).alias("lot_key"),
    )


# --- joins ---------------------------------------------------------------------------------------------------------


@query("inventory_enriched", with_views("inventory", f"SELECT {INVENTORY_SELECT} FROM inventory"))
def inventory_enriched(spark, d):
    return big(inventory(spark, d))


@query(
    "top_products_semi",
    with_views(
        "products",
        f"""SELECT product_id, product_name, CAST(department_id AS BIGINT) AS department_id FROM products
            WHERE product_id IN ({TOP_ITEMS})""",
    ),
)
def top_products_semi(spark, d):
    ids = A.top_k(B.baskets(spark, d), "item", 50).select(F.col("item").alias("product_id"))
    return big(J.keep_listed(B.products(spark, d), ids, "product_id").select("product_id", "product_name", "department_id"))


@query(
    "catalog_lookup",
    with_views(
        "movements",
        """WITH listed AS (SELECT product_name, max(product_id) AS last_id, arg_max(department_id, product_id) AS department_id
             FROM products WHERE product_name NOT LIKE 'red%' GROUP BY 1)
           SELECT s.product_name, coalesce(l.last_id, 0) AS last_id, CAST(coalesce(l.department_id, 0) AS BIGINT) AS department_id
           FROM (SELECT DISTINCT product_name FROM movements) s LEFT JOIN listed l ON l.product_name = s.product_name""",
    ),
)
def catalog_lookup(spark, d):
    """Names are shared by several products; the last one listed wins, red products are not listed."""
    listed = B.products(spark, d).filter("product_name NOT LIKE 'red%'").withColumn("last_id", F.col("product_id"))
    pool = J.last_by_key(listed, "product_name", "product_id", ["last_id", "department_id"])
    seen = B.movements(spark, d).select("product_name").distinct()
    return big(J.lookup(seen, pool, "product_name", {"last_id": 0, "department_id": 0}))


@query(
    "mandatory_lookup",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey AS product_id, p_name AS product_name FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def mandatory_lookup(spark, d):
    lines = B.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").alias("product_id")
    )
    named = J.mandatory_lookup(lines, B.products(spark, d), "product_id", "product_name")
    return big(named.select("l_orderkey", "l_linenumber", "product_id", "product_name"))


NUTRITION = f"""WITH best AS (SELECT name_key, arg_min(rank, rank) AS rank, arg_min(size, rank) AS size
      FROM nutrition GROUP BY name_key),
  hits AS (SELECT name_key, rank * 3.0e0 AS calories_100g, size / 2.0e0 AS proteins_100g,
      (rank % 40) * 1.0e0 AS carbs_100g FROM best)
  SELECT {{cols}}, calories_100g, proteins_100g, carbs_100g, {SCORE.format('calories_100g')} AS nutriscore
  FROM {{source}} p LEFT JOIN hits h ON h.name_key = trim(replace(p.product_name, 'Organic', ''))"""


@query(
    "nutrient_pivot",
    with_views("nutrition", NUTRITION.format(cols="p.product_id", source="products")),
)
def nutrient_pivot(spark, d):
    products = B.products(spark, d).select("product_id", "product_name")
    return J.add_nutrition(products, B.nutrition_reference(spark, d)).drop("product_name")


@query(
    "build_catalog",
    with_views(
        "nutrition movements",
        NUTRITION.format(
            cols="p.product_id, p.product_name, CAST(p.category AS BIGINT) AS category",
            source="""(SELECT s.product_id, coalesce(q.product_name, 'Unknown Product') AS product_name,
                coalesce(q.department_id, 0) AS category FROM (SELECT DISTINCT product_id FROM movements) s
                LEFT JOIN products q ON q.product_id = s.product_id)""",
        ),
    ),
)
def build_catalog(spark, d):
    return big(
        J.build_catalog(B.movements(spark, d), B.products(spark, d), B.nutrition_reference(spark, d))
    ).select("product_id", "product_name", "category", *schemas.NUTRIENTS, "nutriscore")


# --- aggregates ----------------------------------------------------------------------------------------------------


@query("hour_distribution", HOUR_SHARES.format("BIGINT"))
def hour_distribution(spark, d):
    return big(A.frequency_shares(B.table(spark, d, "events").select(F.hour("ts").alias("hour")), "hour"))


@query("event_counts", with_views("movements", "SELECT event_type, count(*) AS n FROM movements GROUP BY 1"))
def event_counts(spark, d):
    return A.value_counts(B.movements(spark, d), "event_type")


@query("classification_counts", with_views("movements", "SELECT classification, count(*) AS n FROM movements GROUP BY 1"))
def classification_counts(spark, d):
    return A.value_counts(B.movements(spark, d), "classification")


@query(
    "top_products",
    with_views(
        "movements",
        """SELECT product_name, count(*) AS n FROM movements WHERE product_name IS NOT NULL GROUP BY 1
           ORDER BY n DESC, product_name LIMIT 10""",
    ),
)
def top_products(spark, d):
    return A.top_k(B.movements(spark, d), "product_name", 10)


@query("distinct_products", with_views("movements", "SELECT product_id, min(row_id) AS first_row FROM movements GROUP BY 1"))
def distinct_products(spark, d):
    return A.distinct_in_order(B.movements(spark, d), "product_id")


_NULL_COLS = [c.strip() for c in INVENTORY_COLS.split(",")]


@query(
    "null_profile",
    with_views(
        "inventory",
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS null_share FROM inventory"
            for c in _NULL_COLS
        )
        + ")",
    ),
)
def null_profile(spark, d):
    return rounded(A.null_profile(inventory(spark, d)), 6, "null_share")


_TYPE_NAMES = """CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  ELSE lower(column_type) END"""
_PROFILED = {
    "events": "event_id,ts,user_id,event_type,value,props",
    "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
    "part": "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
}


@query(
    "table_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST({len(c.split(','))} AS BIGINT) AS n_cols, "
        f"'{c}' AS columns, (SELECT string_agg({_TYPE_NAMES}, ',') FROM (DESCRIBE {t})) AS types FROM {t}"
        for t, c in _PROFILED.items()
    ),
)
def table_profile(spark, d):
    return A.table_profile({name: B.table(spark, d, name) for name in _PROFILED})


WASTE = """CAST(coalesce(sum(quantity) FILTER (WHERE event_type = 'IN'), 0) AS BIGINT) AS in_qty,
  CAST(coalesce(sum(quantity) FILTER (WHERE classification IN ('Waste', 'Forced_Waste')), 0) AS BIGINT) AS waste_qty"""


@query(
    "waste_rate_by_lot",
    with_views(
        "movements",
        f"""SELECT household_id, stock_id, in_qty, waste_qty,
              round(CASE WHEN in_qty > 0 THEN CAST(waste_qty AS DOUBLE) / in_qty END, 6) AS waste_rate
            FROM (SELECT household_id, stock_id, {WASTE} FROM movements GROUP BY 1, 2)""",
    ),
)
def waste_rate_by_lot(spark, d):
    return rounded(big(A.waste_rate(B.movements(spark, d), "household_id", "stock_id")), 6, "waste_rate")


# --- ledger --------------------------------------------------------------------------------------------------------

LEDGER = """SELECT row_id, household_id, stock_id, CAST(sum(CASE WHEN event_type = 'IN' THEN quantity ELSE -quantity END)
  OVER (PARTITION BY household_id, stock_id ORDER BY date_trunc('hour', timestamp),
    CASE WHEN event_type = 'IN' THEN 0 ELSE 1 END, timestamp, row_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance
  FROM movements"""


@query("lot_ledger", with_views("movements", LEDGER))
def lot_ledger(spark, d):
    return big(L.lot_ledger(B.movements(spark, d)).select("row_id", "household_id", "stock_id", "balance"))


@query("lot_ledger_split", with_views("movements", LEDGER))
def lot_ledger_split(spark, d):
    """The same ledger with every lot treated as hot: range slices and carried totals."""
    return big(L.lot_ledger(B.movements(spark, d), hot_rows=0).select("row_id", "household_id", "stock_id", "balance"))


# The state of each lot, day by day: latest expiry and balance, and what is written off between two days or after the last one.
LOT_STATES = """lot_days AS (SELECT *, row_number() OVER (PARTITION BY household_id, stock_id ORDER BY day) AS rn FROM (
    SELECT household_id, stock_id, day, CAST(sum(CASE WHEN event_type = 'IN' THEN quantity ELSE -quantity END) AS BIGINT) AS net,
      max(expiry_date) FILTER (WHERE event_type = 'IN') AS expiry, max(product_id) AS product_id, max(product_name) AS product_name
    FROM movements GROUP BY 1, 2, 3)),
  states AS (SELECT household_id, stock_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS DATE) AS day, CAST(NULL AS DATE) AS expiry, CAST(0 AS BIGINT) AS balance,
      CAST(NULL AS DATE) AS gone_expiry, CAST(0 AS BIGINT) AS gone FROM lot_days WHERE rn = 1
    UNION ALL SELECT d.household_id, d.stock_id, d.rn, d.day,
      CASE WHEN s.expiry + 3 < d.day THEN d.expiry ELSE greatest(s.expiry, d.expiry) END,
      CASE WHEN s.expiry + 3 < d.day THEN least(s.balance, 0) ELSE s.balance END + d.net,
      s.expiry, CASE WHEN s.expiry + 3 < d.day THEN greatest(s.balance, 0) ELSE 0 END
    FROM states s JOIN lot_days d ON d.household_id = s.household_id AND d.stock_id = s.stock_id AND d.rn = s.rn + 1),
  last_states AS (SELECT *, expiry + 3 <= (SELECT max(day) FROM movements) AND balance > 0 AS ends FROM states
    QUALIFY row_number() OVER (PARTITION BY household_id, stock_id ORDER BY rn DESC) = 1),
  gone_rows AS (SELECT household_id, stock_id, gone_expiry AS expiry_date, gone AS quantity, rn - 1 AS upto FROM states WHERE gone > 0
    UNION ALL SELECT household_id, stock_id, expiry, balance, rn FROM last_states WHERE ends),
  w AS (SELECT household_id, stock_id, product_id, product_name, quantity, expiry_date + 3 + INTERVAL '23 hours 59 minutes 59 seconds' AS timestamp,
      expiry_date, expiry_date + 3 AS due FROM gone_rows JOIN (SELECT DISTINCT household_id, stock_id, product_id, product_name FROM lot_days)
      USING (household_id, stock_id))"""
WRITEOFFS = f"""WITH RECURSIVE {LOT_STATES} SELECT household_id, stock_id, product_id, product_name, quantity, timestamp, expiry_date FROM w"""


@query("expiry_writeoff", with_views("movements", WRITEOFFS))
def expiry_writeoff(spark, d):
    return big(
        L.expiry_writeoffs(B.movements(spark, d)).select(
            "household_id", "stock_id", "product_id", "product_name", "quantity", "timestamp", "expiry_date"
        )
    )


@query(
    "movements_union",
    with_views(
        "movements",
        f"""WITH RECURSIVE {LOT_STATES},
          u AS (SELECT household_id, stock_id, event_type, classification, quantity, day FROM movements
            UNION ALL SELECT household_id, stock_id, 'OUT', 'Forced_Waste', quantity, CAST(timestamp AS DATE) FROM w)
          SELECT event_type, classification, day, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity
          FROM u GROUP BY 1, 2, 3""",
    ),
)
def movements_union(spark, d):
    m = B.movements(spark, d)
    log = L.movements_with_writeoffs(
        m.filter("classification = 'Purchase'"),
        m.filter("classification IN ('Consumption', 'Waste')"),
        L.expiry_writeoffs(m),
    )
    return log.groupBy("event_type", "classification", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )


@query(
    "open_lots",
    with_views(
        "movements",
        f"""WITH RECURSIVE {LOT_STATES}
          SELECT household_id, stock_id, balance, lot_expiry FROM last_states JOIN (
            SELECT household_id, stock_id, max(expiry_date) AS lot_expiry FROM movements WHERE event_type = 'IN' GROUP BY 1, 2)
            USING (household_id, stock_id)
          WHERE balance > 0 AND NOT coalesce(ends, false)""",
    ),
)
def open_lots(spark, d):
    return big(L.open_lots(B.movements(spark, d)))


# --- sessions, co-occurrence, graph --------------------------------------------------------------------------------


def _numbered(event_type: str, gap: int) -> str:
    return f"""gaps AS (SELECT *, CASE WHEN epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w) <= {gap * 1_000_000}
        THEN 0 ELSE 1 END AS starts FROM movements WHERE event_type = '{event_type}'
        WINDOW w AS (PARTITION BY household_id ORDER BY timestamp, row_id)),
      numbered AS (SELECT *, CAST(sum(starts) OVER (PARTITION BY household_id ORDER BY timestamp, row_id
        ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM gaps)"""


def _sessions_sql(event_type: str, gap: int) -> str:
    return with_views(
        "movements",
        f"""WITH {_numbered(event_type, gap)}
        SELECT household_id, session_no, min(timestamp) AS session_start, max(timestamp) AS session_end,
          count(*) AS n_events, CAST(sum(quantity) AS BIGINT) AS quantity, count(DISTINCT product_id) AS n_products
        FROM numbered GROUP BY 1, 2""",
    )


@query("restock_sessions", _sessions_sql("IN", 3600))
def restock_sessions(spark, d):
    return big(SE.sessions(B.movements(spark, d), "IN"))


@query("kitchen_sessions", _sessions_sql("OUT", 900))
def kitchen_sessions(spark, d):
    return big(SE.sessions(B.movements(spark, d), "OUT"))


@query(
    "session_events",
    with_views("movements", f"WITH {_numbered('OUT', 900)} SELECT row_id, household_id, session_no FROM numbered"),
)
def session_events(spark, d):
    return big(SE.assign_sessions(B.movements(spark, d), "OUT").select("row_id", "household_id", "session_no"))


PAIRS = """SELECT a.event_type, a.product_id AS product_a, b.product_id AS product_b, count(*) AS n_pairs
  FROM movements a JOIN movements b ON a.household_id = b.household_id AND a.event_type = b.event_type
    AND a.product_id < b.product_id
    AND abs(epoch_us(a.timestamp) - epoch_us(b.timestamp)) <= CASE a.event_type WHEN 'IN' THEN 3600000000 ELSE 900000000 END
  GROUP BY 1, 2, 3"""


@query("cooccurrence_pairs", with_views("movements", PAIRS))
def cooccurrence_pairs(spark, d):
    return C.proximity_pairs(B.movements(spark, d))


@query("cooccurrence_pairs_split", with_views("movements", PAIRS))
def cooccurrence_pairs_split(spark, d):
    """The same counts with every neighbouring bin treated as hot."""
    return C.proximity_pairs(B.movements(spark, d), hot_pairs=0)


@query(
    "cooccurrence_freq",
    with_views(
        "movements",
        f"""WITH {_numbered('IN', 3600)},
          w AS (SELECT DISTINCT household_id, session_no, product_id FROM numbered)
          SELECT a.product_id AS product_id_a, b.product_id AS product_id_b, count(*) AS n_windows,
            round(count(*) / CAST((SELECT count(*) FROM (SELECT DISTINCT household_id, session_no FROM w)) AS DOUBLE), 9)
              AS frequency
          FROM w a JOIN w b ON a.household_id = b.household_id AND a.session_no = b.session_no
            AND a.product_id < b.product_id GROUP BY 1, 2""",
    ),
)
def cooccurrence_freq(spark, d):
    windows = SE.session_products(B.movements(spark, d), "IN")
    return rounded(C.pair_frequency(windows, ["household_id", "session_no"], "product_id"), 9, "frequency")


@query(
    "pair_rules",
    with_views(
        "baskets",
        """WITH n AS (SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM baskets),
          i AS (SELECT item, count(*) AS c FROM baskets GROUP BY 1),
          p AS (SELECT a.item AS a, b.item AS b, count(*) AS c FROM baskets a JOIN baskets b
            ON a.basket = b.basket AND a.item <> b.item GROUP BY 1, 2 HAVING count(*) >= 2)
          SELECT p.a AS antecedent, p.b AS consequent, p.c AS n_pair, round(p.c / n.n, 9) AS support,
            round(p.c / CAST(ia.c AS DOUBLE), 6) AS confidence,
            round(p.c * n.n / (CAST(ia.c AS DOUBLE) * ib.c), 6) AS lift
          FROM p JOIN i ia ON ia.item = p.a JOIN i ib ON ib.item = p.b CROSS JOIN n""",
    ),
)
def pair_rules(spark, d):
    rules = C.pair_rules(B.baskets(spark, d), "basket", "item", min_count=2)
    return rounded(rounded(rules, 6, "confidence", "lift"), 9, "support")


@query(
    "fp_rules",
    with_views(
        "baskets",
        """WITH n AS (SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM baskets),
          i AS (SELECT item, count(*) AS c FROM baskets GROUP BY 1),
          f AS (SELECT item, c FROM i WHERE c >= 3),
          p AS (SELECT a.item AS a, b.item AS b, count(*) AS c FROM baskets a JOIN baskets b
            ON a.basket = b.basket AND a.item <> b.item GROUP BY 1, 2),
          k AS (SELECT p.* FROM p WHERE p.c >= 3),
          t AS (SELECT x.item AS a, y.item AS b, z.item AS c3, count(*) AS c FROM baskets x
            JOIN baskets y ON x.basket = y.basket AND x.item < y.item
            JOIN baskets z ON z.basket = y.basket AND z.item <> y.item AND z.item <> x.item GROUP BY 1, 2, 3),
          kt AS (SELECT t.* FROM t WHERE t.c >= 3),
          r AS (SELECT CAST(k.a AS VARCHAR) AS antecedent, CAST(k.b AS VARCHAR) AS consequent, k.c, ia.c AS ca, ib.c AS cb
              FROM k JOIN i ia ON ia.item = k.a JOIN i ib ON ib.item = k.b
            UNION ALL SELECT kt.a || ',' || kt.b, CAST(kt.c3 AS VARCHAR), kt.c, kp.c, ib.c
              FROM kt JOIN k kp ON kp.a = kt.a AND kp.b = kt.b JOIN i ib ON ib.item = kt.c3)
          SELECT antecedent, consequent, round(r.c / CAST(ca AS DOUBLE), 6) AS confidence,
            round(r.c * n.n / (CAST(ca AS DOUBLE) * cb), 8) AS lift, round(r.c / n.n, 9) AS support
          FROM r CROSS JOIN n WHERE r.c >= 0.0501e0 * ca""",
    ),
)
def fp_rules(spark, d):
    rules = C.itemset_rules(B.baskets(spark, d), "basket", "item", min_confidence=0.0501, min_count=3)
    return rounded(rounded(rounded(rules, 6, "confidence"), 8, "lift"), 9, "support")


RESTOCK = {"IN": SE.SESSION_GAP["IN"]}


@query(
    "degree_centrality",
    with_views(
        "movements",
        f"""WITH p AS ({PAIRS}),
          e AS (SELECT product_a AS a, product_b AS b, n_pairs AS w FROM p WHERE event_type = 'IN')
          SELECT product_id, count(*) AS degree, CAST(sum(w) AS BIGINT) AS weighted_degree
          FROM (SELECT a AS product_id, w FROM e UNION ALL SELECT b, w FROM e) GROUP BY 1""",
    ),
)
def degree_centrality(spark, d):
    return G.degree_centrality(C.proximity_pairs(B.movements(spark, d), RESTOCK))


def _pagerank_sql(iterations: int) -> str:
    rounds = ",\n".join(
        f"r{i} AS (SELECT s.dst AS product_id, 0.15e0 / nn.n + 0.85e0 * sum(r.rank * s.share) AS rank "
        f"FROM s JOIN r{i - 1} r ON r.product_id = s.src CROSS JOIN nn GROUP BY s.dst, nn.n)"
        for i in range(1, iterations + 1)
    )
    return with_views(
        "movements",
        f"""WITH p AS MATERIALIZED ({PAIRS}),
          e AS (SELECT product_a AS src, product_b AS dst, n_pairs AS w FROM p WHERE event_type = 'IN'
            UNION ALL SELECT product_b, product_a, n_pairs FROM p WHERE event_type = 'IN'),
          s AS MATERIALIZED (SELECT src, dst, w / CAST(sum(w) OVER (PARTITION BY src) AS DOUBLE) AS share FROM e),
          nn AS (SELECT CAST(count(DISTINCT src) AS DOUBLE) AS n FROM s),
          r0 AS (SELECT DISTINCT s.src AS product_id, 1.0e0 / nn.n AS rank FROM s CROSS JOIN nn),
          {rounds}
          SELECT product_id, round(rank, 6) AS rank FROM r{iterations}""",
    )


@query("pagerank", _pagerank_sql(20))
def pagerank(spark, d):
    edges = C.proximity_pairs(B.movements(spark, d), RESTOCK)
    return rounded(G.pagerank(edges), 6, "rank")


# --- checks --------------------------------------------------------------------------------------------------------


@query(
    "dup_keys",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dup_keys(spark, d):
    return big(Q.duplicate_keys(B.table(spark, d, "lineitem"), "l_orderkey", "l_linenumber"))


INTEGRITY = f"""WITH ledger AS ({LEDGER}),
  lots AS (SELECT count(*) FILTER (WHERE event_type = 'IN') AS n_in,
      count(*) FILTER (WHERE classification IN ('Waste', 'Forced_Waste')) AS n_waste,
      min(product_id) AS lo, max(product_id) AS hi,
      sum(CASE WHEN event_type = 'IN' THEN quantity ELSE -quantity END) AS balance
    FROM movements GROUP BY household_id, stock_id),
  integrity AS (
    SELECT 'waste_without_in' AS "check", CAST(coalesce(sum(n_waste) FILTER (WHERE n_in = 0), 0) AS BIGINT) AS violations FROM lots
    UNION ALL SELECT 'mixed_products', count(*) FILTER (WHERE lo <> hi) FROM lots
    UNION ALL SELECT 'lots_ending_negative', count(*) FILTER (WHERE balance < 0) FROM lots
    UNION ALL SELECT 'rows_below_zero', count(*) FILTER (WHERE balance < 0) FROM ledger)"""


@query("lot_integrity", with_views("movements", INTEGRITY + " SELECT * FROM integrity"))
def lot_integrity(spark, d):
    m = B.movements(spark, d)
    return Q.lot_integrity(m, L.lot_ledger(m))


def _domain_sql(col: str) -> str:
    allowed = ", ".join(f"'{v}'" for v in Q.DOMAINS[col] if v != "Waste")
    return (
        f"SELECT '{col}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {col} NOT IN ({allowed})) AS bad, "
        f"count(*) FILTER (WHERE {col} IS NULL) AS nulls, "
        f"round(count(*) FILTER (WHERE {col} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS null_share FROM inventory"
    )


@query("domain_checks", with_views("inventory", " UNION ALL ".join(_domain_sql(c) for c in Q.DOMAINS)))
def domain_checks(spark, d):
    # 'Waste' is left out of the allowed values, so that the check has something to find.
    domains = {c: [v for v in vs if v != "Waste"] for c, vs in Q.DOMAINS.items()}
    return rounded(Q.domain_checks(inventory(spark, d), domains), 6, "null_share")


@query(
    "written_profile",
    with_views(
        "inventory",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS null_share, "
            + (f"count(*) FILTER (WHERE {c} NOT IN ({', '.join(repr(v) for v in Q.DOMAINS[c] if v != 'Waste')}))" if c in Q.DOMAINS else "CAST(NULL AS BIGINT)")
            + " AS bad FROM inventory"
            for c in _NULL_COLS
        ),
    ),
)
def written_profile(spark, d):
    """Nulls and values outside their domains, counted while the inventory is written."""
    domains = {c: [v for v in vs if v != "Waste"] for c, vs in Q.DOMAINS.items()}
    stock = inventory(spark, d)
    seen = Q.observed_write(stock, scratch_path(spark, "profiled"), Q.profile_measures(stock, domains))
    return rounded(Q.profile_rows(spark, stock, seen, domains), 6, "null_share")


def _checks(spark: SparkSession, d: str) -> DataFrame:
    c = B.catalog(spark, d)
    # The inventory is written once; that write counts its rows and nulls, and the checks by key read the written columns they need.
    stock = inventory(spark, d)
    path = scratch_path(spark, "checked")
    seen = Q.observed_write(stock, path, Q.profile_measures(stock))
    m = spark.read.schema(stock.schema).parquet(path)
    integrity = Q.lot_integrity(m, L.lot_ledger(m))
    violations = integrity.select(
        F.lit("lots").alias("component"),
        "check",
        F.when(F.col("check").isin("rows_below_zero", "mixed_products"), "error").otherwise("warning").alias("severity"),
        (F.col("violations") == 0).alias("passed"),
    )
    unique = lambda df, *keys: Q.duplicate_keys(df, *keys)
    none = F.count(F.lit(1)) == 0
    return Q.union_checks(
        [
            Q.check_row("movements", "unique event_id", "error", unique(m, "event_id"), none),
            Q.check_row("catalog", "unique product_id", "error", unique(c, "product_id"), none),
            Q.known_row(spark, "movements", "rows present", "error", seen["rows"] > 0),
            Q.known_row(spark, "catalog", "scores present", "warning", seen["nulls nutriscore"] == 0),
            violations,
        ]
    )


CHECKS = (
    INTEGRITY
    + """, checks AS (
      SELECT 'movements' AS component, 'error' AS severity, (SELECT count(*) FROM (SELECT event_id FROM movements
        GROUP BY 1 HAVING count(*) > 1)) = 0 AS passed
      UNION ALL SELECT 'catalog', 'error', (SELECT count(*) FROM (SELECT product_id FROM catalog GROUP BY 1 HAVING count(*) > 1)) = 0
      UNION ALL SELECT 'movements', 'error', (SELECT count(*) FROM movements) > 0
      UNION ALL SELECT 'catalog', 'warning', (SELECT count(*) FROM inventory WHERE nutriscore IS NULL) = 0
      UNION ALL SELECT 'lots', CASE WHEN "check" IN ('rows_below_zero', 'mixed_products') THEN 'error' ELSE 'warning' END,
        violations = 0 FROM integrity)"""
)


@query(
    "dq_status",
    with_views(
        "inventory",
        CHECKS
        + """ SELECT components, errors, warnings, CASE WHEN errors = 0 THEN 'READY' WHEN errors < 3 THEN 'MOSTLY READY'
            ELSE 'NOT READY' END AS status FROM (SELECT count(DISTINCT component) AS components,
            count(*) FILTER (WHERE NOT passed AND severity = 'error') AS errors,
            count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings FROM checks)""",
    ),
)
def dq_status(spark, d):
    return Q.status(_checks(spark, d))


@query(
    "dq_components",
    with_views(
        "inventory",
        CHECKS
        + " SELECT component, bool_and(passed) AS all_passed, bool_or(passed) AS any_passed FROM checks GROUP BY 1",
    ),
)
def dq_components(spark, d):
    return Q.component_status(_checks(spark, d))


@query(
    "dq_pass_rate",
    with_views(
        "inventory",
        CHECKS
        + """ SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
            round(coalesce(avg(CASE WHEN passed THEN 1.0e0 ELSE 0.0e0 END) * 100, 0), 6) AS percentage FROM checks""",
    ),
)
def dq_pass_rate(spark, d):
    return rounded(Q.pass_rate(_checks(spark, d)), 6, "percentage")
