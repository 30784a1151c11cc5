"""SQL text of the inventory views, for the comparison queries."""

from __future__ import annotations

from larder.functions.scalars import DEFAULT_SHELF_LIFE, LAST_SCORE, MISSING_SCORE, SCORE_UPPER_BOUNDS, SHELF_LIFE_DAYS, STOP_WORDS
from larder.sources.bindings import DEPARTMENT_BY_TYPE, NOT_FOUND, NOT_LISTED, OTHER_DEPARTMENT

SCORE = (
    f"CASE WHEN {{0}} IS NULL THEN '{MISSING_SCORE}' " + " ".join(f"WHEN {{0}} < {bound:g} THEN '{grade}'" for grade, bound in SCORE_UPPER_BOUNDS) + f" ELSE '{LAST_SCORE}' END"
)
SHELF = "CASE {0} " + " ".join(f"WHEN {k} THEN {days}" for k, days in SHELF_LIFE_DAYS.items()) + f" ELSE {DEFAULT_SHELF_LIFE} END"
DEPARTMENT = "CASE p_type " + " ".join(f"WHEN '{t}' THEN {k}" for t, k in DEPARTMENT_BY_TYPE.items()) + f" ELSE {OTHER_DEPARTMENT} END"

_VIEWS: dict[str, tuple[list[str], str]] = {
    "products": (
        [],
        f"SELECT p_partkey AS product_id, p_name AS product_name, {DEPARTMENT} AS department_id, p_size AS size, p_brand AS brand FROM part",
    ),
    "catalog": (
        ["products"],
        f"""SELECT proteins_100g, carbs_100g, calories_100g, product_id, product_name, category,
              {SCORE.format('calories_100g')} AS nutriscore
            FROM (SELECT CASE WHEN product_id % 7 = 2 THEN NULL ELSE size / 4.0e0 END AS proteins_100g,
                    CAST(product_id % 90 AS DOUBLE) AS carbs_100g,
                    CASE WHEN product_id % 10 = 3 THEN NULL ELSE product_id * 5.0e0 END AS calories_100g,
                    product_id, product_name, department_id AS category
                  FROM products WHERE brand <> '{NOT_LISTED}')""",
    ),
    "raw_movements": (
        [],
        """SELECT event_id AS row_id, CAST(event_id AS VARCHAR) AS event_id, user_id % 10 AS household_id,
              CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS product_id,
              CASE WHEN event_type IN ('purchase', 'signup') THEN 'IN' ELSE 'OUT' END AS event_type,
              1 + event_id % 3 AS quantity, ts AS timestamp, CAST(ts AS DATE) AS day FROM events""",
    ),
    "movements": (
        ["products", "catalog", "raw_movements"],
        f"""SELECT row_id, event_id, household_id, household_id || '-' || product_id AS stock_id, product_id,
              product_name, event_type, quantity, timestamp, day, expiry_date,
              CASE WHEN event_type = 'IN' THEN 'Purchase' 
                   WHEN day > expiry_date THEN 'Waste' ELSE 'Consumption' END AS classification
            FROM (SELECT m.*, p.product_name,
                    CASE WHEN event_type = 'IN' THEN day + CAST({SHELF.format('c.category')} AS INTEGER)
                         ELSE day + CAST(row_id % 9 - 4 AS INTEGER) END AS expiry_date
                  FROM raw_movements m LEFT JOIN products p ON p.product_id = m.product_id
                  LEFT JOIN catalog c ON c.product_id = m.product_id)""",
    ),
    "inventory": (
        ["movements", "catalog"],
        """SELECT m.*, c.nutriscore, c.calories_100g, c.proteins_100g, c.carbs_100g, c.category
           FROM movements m LEFT JOIN catalog c ON c.product_id = m.product_id""",
    ),
    "vectors": ([], "SELECT vec_id AS row_id, list_transform(embedding, lambda x: x::DOUBLE * 2) AS f FROM embeddings"),
    "nutrition": (
        ["products"],
        f"""SELECT trim(replace(product_name, 'Organic', '')) AS name_key, product_id AS rank, size FROM products
           WHERE brand <> '{NOT_FOUND}'""",
    ),
    "baskets": ([], "SELECT DISTINCT l_orderkey AS basket, l_partkey AS item FROM lineitem"),
}


def with_views(names: str, body: str) -> str:
    """``body`` behind the views it needs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _VIEWS[name][0]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    ctes = ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in ordered)
    rest = body.strip()
    recursive = rest.upper().startswith("WITH RECURSIVE")
    if recursive:
        return f"WITH RECURSIVE {ctes},\n{rest[len('WITH RECURSIVE'):]}"
    if rest.upper().startswith("WITH "):
        return f"WITH {ctes},\n{rest[len('WITH '):]}"
    return f"WITH {ctes}\n{rest}"


STOP_LIST = ", ".join(f"'{w}'" for w in STOP_WORDS)


def tokens_sql(text: str) -> str:
    return (
        f"list_filter(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
        f"lambda t: t NOT IN ({STOP_LIST}))"
    )
