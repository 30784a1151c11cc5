"""License scan: ordered signature rules behind keyword filters, in DataFrame functions only."""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import only
from larder.llm.license_rules import BASE, GATES, Rule, rules

#: What separates words once A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LEVELS = 5
_OPEN, _CLOSE = "\x01", "\x02"  # no normalised text holds them
_HITS = "array<struct<start:int,stop:int,level:int,rule:int,label:string>>"


def normalised(text: Column) -> Column:
    """A-Z in lower case and one space around every word; a text without a word gives one space."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.concat(F.lit(" "), F.ltrim(F.concat(F.trim(F.regexp_replace(lower, SEPARATORS, " ")), F.lit(" "))))


def spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(text: Column, rule: Column) -> Column:
    """Where a rule matches whole words, as arrays of (start, stop) in words, stop excluded: marks are put around the matches, and
    the marked words are found by their place in the split text. Linear in the text, however many matches there are."""
    marked = F.split(F.trim(F.regexp_replace(text, F.concat(F.lit("(?<= )(?:"), rule.regex, F.lit(")(?= )")), F.lit(f"{_OPEN}$0{_CLOSE}"))), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(F.startswith(w, F.lit(_OPEN)), i)), lambda i: i.isNotNull())
    stops = F.filter(F.transform(marked, lambda w, i: F.when(F.endswith(w, F.lit(_CLOSE)), i + 1)), lambda i: i.isNotNull())
    return F.zip_with(
        starts, stops, lambda a, b: F.struct(a.alias("start"), b.alias("stop"), rule.level.alias("level"), rule.rule.alias("rule"), rule.label.alias("label"))
    )


def _summary(hits: Column) -> Column:
    """Labels and covered words of the hits that are left after suppression, in one sweep over hits sorted by start.

    ``ends`` holds the furthest stop seen on each level, which decides containment: what has been seen starts no later.
    """
    zero = F.struct(
        F.array_repeat(F.lit(0), LEVELS).alias("ends"), F.array().cast("array<string>").alias("labels"),
        F.lit(0).alias("covered"), F.lit(0).alias("upto"),
    )

    def step(state: Column, hit: Column) -> Column:
        hidden = F.array_max(F.slice(state.ends, F.lit(1), hit.level)) >= hit.stop
        hidden = F.coalesce(hidden, F.lit(False)) | (F.element_at(state.ends, hit.level + 1) >= hit.stop)
        ends = F.transform(state.ends, lambda e, i: F.when(i == hit.level, F.greatest(e, hit.stop)).otherwise(e))
        gain = F.greatest(hit.stop - F.greatest(hit.start, state.upto), F.lit(0))
        return F.when(hidden, F.struct(ends.alias("ends"), state.labels.alias("labels"), state.covered.alias("covered"), state.upto.alias("upto"))).otherwise(
            F.struct(
                ends.alias("ends"),
                F.when(F.array_contains(state.labels, hit.label), state.labels).otherwise(F.array_append(state.labels, hit.label)).alias("labels"),
                (state.covered + gain).alias("covered"), F.greatest(state.upto, hit.stop).alias("upto"),
            )
        )

    return F.aggregate(hits, zero, step)


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, hits, n_base, first_word, last_word, base_labels, labels and score.

    A rule is tried only where its coarse gate and its own keyword stand in the text. ``hits`` has every match as words from start to
    stop, sorted. A hit is suppressed when another one of the same or a higher priority (a smaller level) covers its words, ties going
    to the first rule; ``labels`` are those of the hits left and the base phrases' own, sorted and joined by commas. ``score`` is the
    share of words that hits left over cover. No row is moved: there is no shuffle.

    A null text is empty; without a word n_words and score are 0 and the places null. Repeated rows give repeated rows; other
    columns are ignored. The work is linear in a text's length for each rule that its keywords let through.
    """
    signatures = signatures or rules()
    listed = [{"rule": i, **r._asdict()} for i, r in enumerate(signatures)]
    table = F.from_json(F.lit(json.dumps(listed)), "array<struct<rule:int,label:string,level:int,gate:string,keyword:string,regex:string>>")
    docs = only(documents, doc_id=doc_id, text=text).select("doc_id", normalised(F.coalesce("text", F.lit(""))).alias("norm"))
    gates = F.filter(F.array(*[F.lit(g) for g in GATES]), lambda g: F.contains(F.col("norm"), g))
    docs = docs.select("doc_id", "norm", (spaces(F.col("norm")) - 1).cast("long").alias("n_words"), gates.alias("gates"))
    tried = F.filter(table, lambda r: F.array_contains(F.col("gates"), r.gate) & F.contains(F.col("norm"), r.keyword))
    hits = F.array_sort(F.flatten(F.transform(tried, lambda r: _matches(F.col("norm"), r))), _before)
    docs = docs.select("doc_id", "n_words", F.when(F.size("gates") > 0, hits).otherwise(F.array().cast(_HITS)).alias("hits"))
    base = F.filter("hits", lambda h: h.rule < len(BASE))
    docs = docs.select("doc_id", "n_words", "hits", base.alias("base"), _summary(F.col("hits")).alias("s"))
    own = F.array_distinct(F.transform("base", lambda h: h.label))
    return docs.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda h: h.start)).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda h: h.start)).cast("long").alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.col("s.labels"))), ",").alias("labels"),
        F.when(F.col("n_words") > 0, F.least(F.lit(1.0), F.col("s.covered") / F.col("n_words"))).otherwise(0.0).alias("score"),
        "hits",
    )


def _before(a: Column, b: Column) -> Column:
    order = lambda x: F.struct(x.start, -x.stop, x.level, x.rule)
    return F.when(order(a) < order(b), -1).when(order(a) > order(b), 1).otherwise(0)


def detections(scanned: DataFrame) -> DataFrame:
    """The spans that suppression leaves, a row each: doc_id, rule, label, level, start, stop. Give each document its own doc_id."""
    hits = scanned.select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
    before = Window.partitionBy("doc_id").orderBy("start", F.desc("stop"), "level", "rule").rowsBetween(Window.unboundedPreceding, -1)
    # Seen so far on a level no lower than the hit's own.
    covers = [F.max(F.when(F.col("level") <= k, F.col("stop"))).over(before) for k in range(LEVELS)]
    hidden = F.element_at(F.array(*covers), F.col("level") + 1) >= F.col("stop")
    return hits.withColumn("hidden", F.coalesce(hidden, F.lit(False))).filter("NOT hidden").drop("hidden")
