"""Feature matrix: imputed nutrients, target encoding, text weights, time parts, standardised."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder import schemas
from larder.functions import scalars as S
from larder.operators.running import HOT_ROWS, running_sums
from larder.session import PART_ROWS, broadcast_if_within, cut, keep

# Fixed value.
MAX_FEATURES = 50
# Terms that a sketch follows, candidates taken from it for each term wanted, and groups in which the tasks' sketches are merged.
TRACKED, CANDIDATES, SKETCH_GROUPS = 50_000, 4, 64


def category_means(df: DataFrame, cols: Sequence[str], by: str, weight: Column | None = None) -> DataFrame:
    """Mean of each column over the rows of a category; ``weight`` counts a row that stands for several."""
    w = F.lit(1) if weight is None else weight

    def mean(c: str) -> Column:
        return (F.sum(F.col(c) * w) / F.sum(F.when(F.col(c).isNotNull(), w))).alias(f"_mean_{c}")

    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(*[mean(c) for c in cols])


def impute_category_mean(
    df: DataFrame,
    cols: Sequence[str] = tuple(schemas.NUTRIENTS),
    by: str = "category",
    means: DataFrame | None = None,
) -> DataFrame:
    """NULL -> mean over the rows of the category -> 0; a row without a category gets 0 even where it has a value.

    The means are added up map-side into one row per category and joined back, so the rows themselves do not move.
    """
    means = keep(category_means(df, cols, by) if means is None else means)
    joined = df.join(broadcast_if_within(means), by, "left")
    filled = {
        c: F.when(F.col(by).isNull(), F.lit(0.0)).otherwise(F.coalesce(F.col(c), F.col(f"_mean_{c}"), F.lit(0.0)))
        for c in cols
    }
    return joined.withColumns(filled).select(*df.columns)


@dataclass(frozen=True)
class Vocabulary:
    """Terms in alphabetical order with their inverse document frequency; at most ``max_features`` of them."""

    terms: list[str]
    idf: list[float]
    totals: list[int] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return [f"txt_{t}" for t in self.terms]


def term_totals(docs: DataFrame, text: str, weight: Column | None = None) -> DataFrame:
    """How often each term occurs; ``weight`` counts a text that stands for several rows."""
    weight = F.lit(1) if weight is None else weight
    spread = docs.select(F.explode(S.tokens(F.col(text))).alias("term"), weight.cast("bigint").alias("w"))
    return spread.groupBy("term").agg(F.sum("w").alias("total"))


def fit_vocabulary(
    docs: DataFrame, text: str, weight: Column | None = None, max_features: int = MAX_FEATURES
) -> Vocabulary:
    """The most frequent terms (ties alphabetically) and their smoothed idf.

    Only the ``max_features`` winners reach the driver. Their document counts come from one more pass with one
    aggregate per term, so no (document, term) table is shuffled.
    """
    weight = F.lit(1) if weight is None else weight
    top = term_totals(docs, text, weight).orderBy(F.desc("total"), "term").limit(max_features).collect()
    total = {r["term"]: r["total"] for r in top}
    terms = sorted(total)
    counted = term_counts(docs.withColumn("_weight", weight.cast("bigint")), text, terms, "_counts")
    seen = [F.sum(F.when(F.col("_counts")[i] > 0, F.col("_weight"))).alias(f"d{i}") for i in range(len(terms))]
    row = counted.agg(F.sum("_weight").alias("n"), *seen).first()
    n = row["n"] or 0
    idf = [math.log((1 + n) / (1 + row[f"d{i}"])) + 1.0 for i in range(len(terms))]
    return Vocabulary(terms, idf, [total[t] for t in terms])


def heavy_terms(docs: DataFrame, text: str, k: int, tracked: int = TRACKED) -> tuple[list[str], int]:
    """Candidates for the most frequent terms, and a bound that no other term's count exceeds, from one pass.

    Each task follows a bounded number of terms in a mergeable frequent-items sketch; sketches are merged by groups of tasks and then as a whole, so no table
    of all terms is shuffled. A term that a sketch does not report has at most twice its error or the least estimate reported.
    """
    spread = docs.select(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g"), F.explode(S.tokens(F.col(text))).alias("term"))
    parts = spread.groupBy("g").agg(F.call_function("approx_top_k_accumulate", F.col("term"), F.lit(tracked)).alias("s"), F.count(F.lit(1)).alias("n"))
    parts = cut(parts)
    if parts.isEmpty():
        return [], 0
    k = min(k, tracked)
    whole = parts.agg(F.call_function("approx_top_k_combine", F.col("s"), F.lit(tracked)).alias("s"), F.sum("n").alias("n"))
    row = whole.select(F.call_function("approx_top_k_estimate", F.col("s"), F.lit(k)).alias("top"), "n").first()
    # The sketch holds up to three quarters of a power of two of terms; its error is 3.5 of all occurrences in that power.
    size = 1 << math.ceil(math.log2(tracked / 0.75))
    bound = int(2 * 3.5 * row["n"] / size)
    return [r["item"] for r in row["top"]], max(bound, row["top"][-1]["count"] if len(row["top"]) == k else 0)


def weigh_terms(
    docs: DataFrame, keys: list[str], text: str, max_features: int = MAX_FEATURES, out: str = "txt", tracked: int = TRACKED
) -> tuple[DataFrame, Vocabulary]:
    """(keys, weights) of every text in the vocabulary of the most frequent terms, and that vocabulary, from two passes over the texts.

    The first finds candidates, the second counts them exactly and keeps their counts, from which totals, document counts and weights follow. Where the
    bound of the first pass does not rule out all other terms, all terms are counted after all.
    """
    terms, bound = heavy_terms(docs, text, CANDIDATES * max_features, tracked)
    vocabulary, counted = None, None
    if terms:
        counter = CountVectorizerModel.from_vocabulary(terms, inputCol="_tokens", outputCol="_tf")
        counted = cut(counter.transform(docs.select(*keys, S.tokens(F.col(text)).alias("_tokens"))).select(*keys, "_tf"))
        cells = counted.select(F.posexplode(vector_to_array("_tf")).alias("i", "n")).filter("n > 0")
        seen = {r["i"]: r for r in cells.groupBy("i").agg(F.sum(F.col("n").cast("long")).alias("total"), F.count(F.lit(1)).alias("texts")).collect()}
        totals, holding = ([seen[i][c] if i in seen else 0 for i in range(len(terms))] for c in ("total", "texts"))
        n_texts = counted.count()
        order = sorted(range(len(terms)), key=lambda i: (-totals[i], terms[i]))[:max_features]
        if totals[order[-1]] > bound or (bound == 0 and len(order) < max_features):
            chosen = sorted(order, key=lambda i: terms[i])
            idf = [math.log((1 + n_texts) / (1 + holding[i])) + 1.0 for i in chosen]
            vocabulary = Vocabulary([terms[i] for i in chosen], idf, [totals[i] for i in chosen])
    if vocabulary is None:
        vocabulary = fit_vocabulary(docs, text, max_features=max_features)
        return add_tfidf(docs, text, vocabulary, out).select(*keys, out), vocabulary
    dense = vector_to_array("_tf")
    picked = bind(dense, lambda v: F.array(*[F.element_at(v, i + 1) * F.lit(w) for i, w in zip(chosen, vocabulary.idf, strict=True)]))
    return counted.select(*keys, bind(picked, scaled_to_unit).alias(out)), vocabulary


def term_counts(docs: DataFrame, text: str, terms: list[str], out: str) -> DataFrame:
    """``docs`` with the array of how often each term occurs; one look-up per token, no shuffle."""
    if not terms:
        return docs.withColumn(out, F.array().cast("array<double>"))
    counter = CountVectorizerModel.from_vocabulary(terms, inputCol="_tokens", outputCol="_tf")
    counted = counter.transform(docs.withColumn("_tokens", S.tokens(F.col(text))))
    return counted.withColumn(out, vector_to_array("_tf")).drop("_tokens", "_tf")


def bind(value: Column, body) -> Column:
    """``body`` over a value that is computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def scaled_to_unit(weights: Column) -> Column:
    norm = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda acc, x: acc + x * x))
    return bind(norm, lambda n: F.transform(weights, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))))


def name_weights(
    inventory: DataFrame, max_features: int = MAX_FEATURES, weight: Column | None = None
) -> tuple[DataFrame, Vocabulary]:
    """Text weights once per distinct name (frequencies count the event rows), and the vocabulary."""
    w = F.lit(1) if weight is None else weight
    names = keep(inventory.groupBy(F.coalesce("product_name", F.lit("")).alias("name")).agg(F.sum(w).alias("n")))
    vocabulary = fit_vocabulary(names, "name", F.col("n"), max_features)
    return add_tfidf(names, "name", vocabulary, "txt"), vocabulary


def add_tfidf(docs: DataFrame, text: str, vocabulary: Vocabulary, out: str) -> DataFrame:
    """``docs`` with the array of count times idf in vocabulary order, scaled to length 1 (all zero without a known
    term); a projection, no shuffle."""
    idf = F.array(*[F.lit(v) for v in vocabulary.idf]).cast("array<double>")
    counted = term_counts(docs, text, vocabulary.terms, "_counts")
    weighted = F.zip_with("_counts", idf, lambda n, w: n * w)
    return counted.withColumn(out, bind(weighted, scaled_to_unit)).drop("_counts")


def long_weights(docs: DataFrame, keys: list[str], col: str, vocabulary: Vocabulary) -> DataFrame:
    """(keys, term, weight) of the non-zero weights."""
    terms = F.array(*[F.lit(t) for t in vocabulary.terms])
    pairs = F.arrays_zip(terms.alias("term"), F.col(col).alias("weight"))
    return docs.select(*keys, F.inline(pairs)).filter("weight > 0")


def target_prior(df: DataFrame, target: Column) -> Column:
    return df.agg(F.avg(target.cast("double"))).scalar()


def target_profile(df: DataFrame, by: str, target: Column) -> tuple[float | None, tuple[int, int]]:
    """The target's mean, and the rows of the largest level and of all, from one pass that adds up by level."""
    levels = df.groupBy(by).agg(F.sum(target.cast("bigint")).alias("s"), F.count(F.lit(1)).alias("n"))
    row = levels.agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("n").alias("most")).first()
    return (row["s"] / row["n"] if row["n"] else None), (row["most"] or 0, row["n"] or 0)


def target_encode_ordered(
    df: DataFrame,
    by: str = "category",
    target: Column | None = None,
    row_id: str = "row_id",
    out: str = "category_encoded",
    hot_rows: int = HOT_ROWS,
    prior: Column | None = None,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """(target sum of earlier rows of the category + prior) / (their number + 1), prior = overall mean.

    ``prior`` and ``sizes`` (rows of the largest category and of all) are worked out unless they are known already.
    """
    target = S.out_indicator(F.col("event_type")) if target is None else target
    if prior is None or sizes is None:
        mean, counted = target_profile(df, by, target)
        prior = F.lit(mean).cast("double") if prior is None else prior
        sizes = counted if sizes is None else sizes
    summed = running_sums(
        df,
        [by],
        [row_id],
        {"_sum": target.cast("bigint"), "_n": F.lit(1).cast("bigint")},
        include_current=False,
        hot_rows=hot_rows,
        sizes=sizes,
    )
    return summed.withColumn(out, (F.col("_sum") + prior) / (F.col("_n") + 1)).drop("_sum", "_n")


def target_encode_static(
    train: DataFrame, rows: DataFrame, by: str = "category", target: Column | None = None, out: str = "category_encoded"
) -> DataFrame:
    """Encoding of unseen rows: (target sum + prior) / (rows + 1) of the category, the prior for an unknown one."""
    target = S.out_indicator(F.col("event_type")) if target is None else target
    prior = target_prior(train, target)
    level = keep(
        train.groupBy(F.col(by).alias("_level")).agg(
            F.sum(target.cast("bigint")).alias("_sum"), F.count(F.lit(1)).alias("_n")
        )
    )
    joined = rows.join(broadcast_if_within(level), F.col(by).eqNullSafe(F.col("_level")), "left")
    encoded = F.coalesce((F.col("_sum") + prior) / (F.col("_n") + 1), prior)
    return joined.withColumn(out, encoded).drop("_level", "_sum", "_n")


def column_stats(df: DataFrame, features: str, width: int) -> tuple[list[float], list[float]]:
    """Mean and population standard deviation of every position, in one pass."""
    items = [F.element_at(features, i + 1) for i in range(width)]
    row = df.agg(
        F.array(*[F.avg(x) for x in items]).alias("mean"), F.array(*[F.stddev_pop(x) for x in items]).alias("std")
    ).first()
    return row["mean"], row["std"]


def standardize(df: DataFrame, features: str, width: int) -> DataFrame:
    """Mean 0 and population variance 1 per position; a constant position becomes 0."""
    means, stds = column_stats(df, features, width)
    # Spread below rounding noise of the mean counts as constant.
    scales = [0.0 if s is None or s <= 1e-12 * max(1.0, abs(m)) else 1.0 / s for m, s in zip(means, stds)]
    stats = F.arrays_zip(
        F.array(*[F.lit(m) for m in means]).alias("m"), F.array(*[F.lit(s) for s in scales]).alias("s")
    )
    scaled = F.zip_with(features, stats, lambda x, p: (x - p["m"]) * p["s"])
    return df.withColumn(features, scaled)


def raw_feature_matrix(
    inventory: DataFrame, max_features: int = MAX_FEATURES, hot_rows: int = HOT_ROWS, carry: Sequence[str] = (), part_rows: int = PART_ROWS
) -> tuple[DataFrame, list[str]]:
    """(row_id, ``carry``, features) before scaling, and the feature names in order.

    There are few categories, so a window over each would leave most tasks idle and the matrix in parts as uneven as the categories are: one that
    holds more than a task's share of the rows (``part_rows`` at least) is cut into slices.
    """
    # Written once: the joins behind the inventory are not worked out for the profile and again for the rows.
    needed = ["row_id", "event_type", "timestamp", "product_name", "category", *schemas.NUTRIENTS]
    narrow = cut(inventory.select(*needed, *[c for c in carry if c not in needed]))
    # One pass adds the rows up by product; name frequencies, category means and sizes and the prior follow from that.
    profile = keep(
        narrow.groupBy("product_name", "category", *schemas.NUTRIENTS, "event_type").agg(F.count(F.lit(1)).alias("n"))
    )
    weights, vocabulary = name_weights(profile, max_features, F.col("n"))
    target = S.out_indicator(F.col("event_type"))
    levels = profile.groupBy("category").agg(F.sum(target * F.col("n")).alias("s"), F.sum("n").alias("n"))
    totals = levels.agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.max("n").alias("most")).first()
    prior = totals["s"] / totals["n"] if totals["n"] else None
    imputed = impute_category_mean(
        narrow, means=category_means(profile, schemas.NUTRIENTS, "category", F.col("n"))
    )
    share = max(part_rows, (totals["n"] or 0) // inventory.sparkSession.sparkContext.defaultParallelism)
    encoded = target_encode_ordered(
        imputed, hot_rows=min(hot_rows, share), prior=F.lit(prior).cast("double"), sizes=(totals["most"] or 0, totals["n"] or 0)
    )
    named = encoded.withColumn("name", F.coalesce("product_name", F.lit("")))
    texted = named.join(broadcast_if_within(weights.select("name", "txt")), "name", "left")
    ts = F.col("timestamp")
    features = F.concat(
        F.array(*schemas.NUTRIENTS, "category_encoded"),
        "txt",
        F.array(S.hour_of_day(ts).cast("double"), S.day_of_week(ts).cast("double")),
    )
    names = [*schemas.NUTRIENTS, "category_encoded", *vocabulary.columns, "hour_of_day", "day_of_week"]
    return texted.select("row_id", *carry, features.alias("features")), names


def feature_matrix(
    inventory: DataFrame, max_features: int = MAX_FEATURES, hot_rows: int = HOT_ROWS, carry: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """(row_id, ``carry``, standardised features) and the feature names in order; the raw matrix is cut once. Scaling is done in every scan
    of the result: where several follow, it is worth a cut."""
    raw, names = raw_feature_matrix(inventory, max_features, hot_rows, carry)
    return standardize(cut(raw), "features", len(names)), names
