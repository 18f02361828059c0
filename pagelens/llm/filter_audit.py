"""Filter interaction audit: what each filter removes in every order in which a set of filters can run.

A document's outcome under any order depends only on which filters it fails, a mask of
bits. Documents are therefore counted per cell (part, mask, labels) first. Each cell then
folds across the array of all orders: ``transform`` over the orders, ``aggregate`` over an
order's filters, which carries what the filters before have removed; five filters give
120 x 5 = 600 structs, weighted by the cell's documents. The cells of a part, at most 128,
merge by elementwise sums.

Whether a text stands under a smaller id is found from counts as well: rows are counted per
(text digest, cell, id), then per (digest, cell) with the count of the least id, so a text that a third of
all rows share is one row per task in the shuffle, and no row is joined to its copies.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelens.llm.common import prepare, table

FILTERS = "ABCDE"
#: Bounds of the conditions: fewest words, percent of distinct words, percent of capitals, characters that fail a text.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 100, 80, 10, "[#$%&*|]"
#: The bit of filter E, the only one that needs other rows.
_COPY = 1 << FILTERS.index("E")
#: What is counted at each step of each order.
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
#: ASCII white space of the word rule.
_GAP = r"[\x20\x09-\x0D]+"


def own_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text (not null) fails.

    A: fewer than MIN_WORDS words; B: distinct words under DISTINCT_PERCENT of its words; C: A-Z over
    CAPITAL_PERCENT of its code points; D: holds one of SYMBOLS. A text without words fails A only.
    """
    words = F.array_remove(F.split(text, _GAP), "")
    # one struct, so that Spark splits a text once
    n = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    bit = lambda name, fails: F.when(fails, 1 << FILTERS.index(name)).otherwise(0)
    ab = F.transform(F.array(n), lambda c: bit("A", c["n"] < MIN_WORDS) + bit("B", c["d"].cast("long") * 100 < c["n"].cast("long") * DISTINCT_PERCENT))[0]
    return ab + bit("C", capitals.cast("long") * 100 > F.char_length(text).cast("long") * CAPITAL_PERCENT) + bit("D", F.regexp_like(text, F.lit(SYMBOLS)))


def marked(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``_id, _good, _toxic`` of each labelled id; of several rows of an id any mark counts. Null ids label nothing."""
    rows = labels.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("_g"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("_t"))
    return rows.groupBy("_id").agg(F.max("_g").alias("_good"), F.max("_t").alias("_toxic"))


def cells(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters they fail."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("_sha"), own_mask(text).alias("_mask"))
    # repeated rows fold before the labels are joined; then only rows of one id with different texts share a key
    rows = rows.groupBy("_id", "_sha", "part", "_mask").agg(F.count(F.lit(1)).alias("_n")).join(marked(labels, id_col), "_id", "left")
    rows = rows.select("_sha", "part", "_mask", "_n", F.coalesce("_good", F.lit(False)).alias("good"), F.coalesce("_toxic", F.lit(False)).alias("toxic"),
                       F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id")).alias("_rank"))
    # a struct's least is that of the least id, which has one row here
    shares = rows.groupBy("_sha", "part", "_mask", "good", "toxic").agg(F.sum("_n").alias("_n"), F.min(F.struct("_rank", "_n")).alias("_least"))
    # at most four label cells of each part stand under a digest, whatever the number of its copies
    first = F.expr("_least._rank = min(_least._rank) OVER (PARTITION BY _sha)")
    shares = shares.withColumn("_stay", F.when(first, F.col("_least._n")).otherwise(0))
    split = shares.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("_mask").alias("mask"), F.col("_stay").alias("n")),
        F.struct((F.col("_mask") + _COPY).alias("mask"), (F.col("_n") - F.col("_stay")).alias("n")))).alias("c"))
    return split.groupBy("part", "c.mask", "good", "toxic").agg(F.sum("c.n").alias("n"))


def orders() -> Column:
    """All orders of the filters, each an array of bits; a fixed value of the plan."""
    return F.array(*[F.array(*[F.lit(1 << FILTERS.index(f)) for f in p]) for p in permutations(FILTERS)])


def folded(cell: Column) -> Column:
    """What each step of each order does with the documents of a cell: an array of a struct of MEASURES a step."""
    n, mask = cell["n"], cell["mask"]
    zero = F.lit(0).cast("long")

    def step(state: Column, bit: Column) -> Column:
        seen, fails = mask.bitwiseAND(state["before"]), mask.bitwiseAND(bit) != 0
        removed = F.when(fails & (seen == 0), n).otherwise(zero)
        counts = F.struct(
            F.when(~fails & (seen == 0), n).otherwise(zero).alias("kept"), removed.alias("removed"),
            F.when(fails & (seen != 0), n).otherwise(zero).alias("redundant"), F.when(mask == bit, n).otherwise(zero).alias("unique_fails"),
            F.when(cell["good"], removed).otherwise(zero).alias("good_lost"), F.when(cell["toxic"], removed).otherwise(zero).alias("toxic_lost"))
        return F.struct(state["before"].bitwiseOR(bit).alias("before"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    start = F.struct(F.lit(0).alias("before"), F.expr(f"cast(array() as array<struct<{','.join(m + ':bigint' for m in MEASURES)}>>)").alias("steps"))
    return F.flatten(F.transform(orders(), lambda order: F.aggregate(order, start, step, lambda s: s["steps"])))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, filter_order, step`` and the counts of MEASURES and ``shapley``, one row per part, order and step, zeros included.

    Parts are the values of ``part_col``, a null being the empty string. A null text counts as empty. E fails a row whose text
    also stands under a smaller id anywhere; a null id is larger than any other, and rows that repeat an id do
    not fail for each other. An empty table has no parts and gives no rows; ``labels`` may be empty.
    """
    prepare(docs.sparkSession)
    cell = F.struct("mask", "good", "toxic", "n")
    parts = cells(docs, labels, id_col, text_col, part_col).groupBy("part").agg(F.collect_list(cell).alias("_cells"))  # at most 32 masks x 4 labels
    zeros = F.transform(F.sequence(F.lit(1), F.lit(len(FILTERS) * len(list(permutations(FILTERS))))), lambda _: F.struct(*[F.lit(0).cast("long").alias(m) for m in MEASURES]))
    summed = F.aggregate("_cells", zeros, lambda acc, c: F.zip_with(acc, folded(c), lambda a, b: F.struct(*[(a[m] + b[m]).alias(m) for m in MEASURES])))
    parts = parts.select("part", summed.alias("_sums"))
    bit = lambda at: F.element_at(F.element_at(orders(), (at / F.lit(len(FILTERS))).cast("int") + 1), at % len(FILTERS) + 1)
    totals = F.transform(F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), lambda f: F.aggregate(
        F.transform("_sums", lambda x, i: F.when(bit(i) == f, x["removed"]).otherwise(0)), F.lit(0).cast("long"), lambda a, x: a + x))
    rows = parts.select("part", totals.alias("_totals"), F.posexplode("_sums").alias("_at", "_s"))
    names = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    rows = rows.withColumns({"filter_order": F.element_at(names, (F.col("_at") / len(FILTERS)).cast("int") + 1), "step": F.col("_at") % len(FILTERS) + 1})
    own = F.instr(F.lit(FILTERS), F.substring(F.col("filter_order"), F.col("step"), F.lit(1)))
    return rows.select("part", "filter_order", "step", *[f"_s.{m}" for m in MEASURES], F.element_at("_totals", own).alias("shapley"))


def op12_mask_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over all documents, by language, in all 120 orders."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT t.doc_id, part,
  (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) OR (doc_id IS NULL AND min(doc_id) OVER (PARTITION BY body) IS NOT NULL) THEN 'E' ELSE '' END) AS fails
  FROM t),
g AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS ng, count(*) FILTER (toxic) AS nt FROM m LEFT JOIN g USING (doc_id) GROUP BY part, fails),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.x <> b.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS earlier FROM o, range(1, 6) r(step)),
k AS (SELECT c.*, s.*, contains(fails, x) AS hit, translate(fails, earlier, '') <> fails AS gone FROM c, s),
r AS (SELECT part, filter_order, step, x, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
  coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = x), 0) AS unique_fails,
  coalesce(sum(ng) FILTER (hit AND NOT gone), 0) AS good_lost, coalesce(sum(nt) FILTER (hit AND NOT gone), 0) AS toxic_lost FROM k GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM r
"""
