"""Removal of passages of lines that repeat across the corpus; chunks are cut by content and hits are extended.

Lines that are not blank have a 32-bit hash each; a rolling hash covers a line and the one
before it, and where it is 0 modulo SPARSE a chunk ends if it has two lines by then, so two texts that share
lines soon cut them alike wherever the lines stand. A single line at the end joins the chunk before it. Chunks
are grouped by their bytes; of equal chunks the earliest stays. DataFrame functions only.

A hit is extended to the whole shared run: every chunk carries the line hashes of the two chunks on
either side of it, the earliest occurrence's travel with it, and as many lines go as agree (64 bits a line);
whole equal chunks further out are hits of their own. Every line that goes stands in an earlier place with the same
neighbours, so of each passage the earliest copy stays. Blank lines go with the line before them.

Grouping is by (hash, text): map-side aggregation folds copies inside a task before
the shuffle, so a chunk that stands in a third of all documents is one row per task.
Occurrences are then matched by two 64-bit hashes, and only where those two stand for
a single text by the byte comparison of the grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelens.llm.common import free, prepare, row_key, table

#: One line in so many may end a chunk.
SPARSE = 2
#: Possible ends that are walked before the chunks found are appended to the text's, so that long texts are not copied at every one.
_BLOCK = 512
_BLANK = " \t\r\n"


def line_hash(line: Column) -> Column:
    """The first 32 bits of the MD5 of a line."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def units(text: Column) -> Column:
    """Array of (x, i) of the lines that are not blank, i counted from 0 over all lines."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    return F.filter(lines, lambda u: F.trim(u["x"], F.lit(_BLANK)) != "")


def both_keys(id_col: str, text_col: str) -> Column:
    """Key of a row by its values, 128 bits: equal rows share it."""
    return F.struct(row_key(id_col, text_col).alias("a"), F.xxhash64(F.lit("\2"), F.col(id_col), F.col(text_col)).alias("b"))


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _key, _no, _from, _to, _text, _before, _after`` of every chunk; _from and _to count the lines that are not blank from 0."""
    rows = docs.select(F.col(id_col).alias("_id"), both_keys(id_col, text_col).alias("_key"), F.transform(units(F.col(text_col)), lambda u: u["x"]).alias("_l"))
    rows = rows.select("*", F.size("_l").alias("_n"), F.transform("_l", line_hash).alias("_h"))
    rolling = lambda i: F.concat(F.coalesce(F.get("_h", i - 1).cast("string"), F.lit("")), F.lit(":"), F.get("_h", i).cast("string"))
    places = F.when(F.col("_n") > 1, F.sequence(F.lit(0), F.col("_n") - 1)).otherwise(F.array().cast("array<int>"))
    may = F.filter(places, lambda i: line_hash(rolling(i)) % SPARSE == 0)
    rows = rows.select("_id", "_key", "_l", "_n", may.alias("_m"))
    none = F.array().cast("array<int>")
    walk = lambda u, c: F.when(c - u["last"] >= 2, F.struct(c.alias("last"), F.concat(u["out"], F.array(c)).alias("out"))).otherwise(u)

    def block(s: Column, part: Column) -> Column:
        walked = F.aggregate(part, F.struct(s["last"], none.alias("out")), walk)
        return F.transform(F.array(walked), lambda r: F.struct(r["last"], F.concat(s["out"], r["out"]).alias("out")))[0]

    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size("_m") / _BLOCK).cast("int")), lambda b: F.slice("_m", b * _BLOCK + 1, _BLOCK))
    ends = F.aggregate(blocks, F.struct(F.lit(-1).alias("last"), none.alias("out")), block, lambda s: s["out"])
    rows = rows.select("_id", "_key", "_l", "_n", ends.alias("_e"))
    # the text's last line ends a chunk; a single line joins the chunk before it
    last = F.coalesce(F.try_element_at("_e", F.lit(-1)), F.lit(-1))
    inner = F.filter("_e", lambda c: c < F.col("_n") - F.when(last == F.col("_n") - 2, 2).otherwise(1))
    rows = rows.select("_id", "_key", "_l", "_n", F.when(F.col("_n") > 1, F.concat(F.array(F.lit(-1)), inner, F.array(F.col("_n") - 1))).alias("_c"))
    part = lambda a, b: F.slice("_l", a + 1, F.greatest(b - a, F.lit(0)))
    hashes = lambda a, b: F.transform(part(a, b), lambda x: F.xxhash64(x))

    def chunk(k: Column) -> Column:
        start, to = F.get("_c", k) + 1, F.get("_c", k + 1)
        return F.struct(k.alias("no"), start.alias("from"), to.alias("to"), F.array_join(part(start, to + 1), "\n").alias("text"),
                        hashes(F.get("_c", F.greatest(k - 2, F.lit(0))) + 1, start).alias("before"),
                        hashes(to + 1, F.coalesce(F.get("_c", k + 3), F.col("_n") - 1) + 1).alias("after"))

    starts = F.sequence(F.lit(0), F.size("_c") - 2)
    # an outer explode: Spark would repeat the work in a filter before an inner one
    rows = rows.select("_id", "_key", F.explode_outer(F.transform(starts, chunk)).alias("_x")).filter("_x IS NOT NULL")
    return rows.select("_id", "_key", *[F.col(f"_x.{c}").alias(f"_{c}") for c in ("no", "from", "to", "text", "before", "after")])


def _hashes() -> list[Column]:
    return [F.xxhash64("_text").alias("_h1"), F.xxhash64(F.lit("\1"), F.col("_text")).alias("_h2")]


def _agree(a: Column, b: Column) -> Column:
    """Elements that two arrays begin with alike."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    odd = F.array_position(same, F.lit(False)).cast("int")
    return F.when(odd == 0, F.size(same)).otherwise(odd - 1)


def removed_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_key, _gone`` of the rows that lose lines; _gone are (from, to) of lines that are not blank, both included, and may overlap.

    The earliest chunk is that of the smallest id (a null id counts as the largest), then of the first line.
    """
    chunks = chunked(docs, id_col, text_col)
    rank = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_key").alias("k"), F.col("_no").alias("c"),
                    F.col("_before").alias("before"), F.col("_after").alias("after"))
    texts = chunks.groupBy("_text").agg(F.count(F.lit(1)).alias("_n"), F.min(rank).alias("_first"))
    classes = texts.select(*_hashes(), "_n", "_first").groupBy("_h1", "_h2").agg(
        F.count(F.lit(1)).alias("_texts"), F.max("_n").alias("_n"), F.min("_first").alias("_first"))
    repeated = classes.filter("_texts = 1 AND _n > 1").select("_h1", "_h2", "_first")
    places = chunks.select("_key", "_no", "_from", "_to", "_before", "_after", *_hashes()).join(repeated, ["_h1", "_h2"])
    later = places.filter((F.col("_first.k") != F.col("_key")) | (F.col("_first.c") != F.col("_no")))
    span = F.struct((F.col("_from") - _agree(F.reverse("_before"), F.reverse("_first.before"))).alias("from"),
                    (F.col("_to") + _agree(F.col("_after"), F.col("_first.after"))).alias("to"))
    return later.groupBy("_key").agg(F.collect_set(span).alias("_gone"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with repeated passages taken out of the text, and ``spans`` (start, lines) of what
    went, counted from 0, in order; null where nothing went. If ``docs`` has a column of that name, the new one gets underscores before it.

    A null text stays null, an empty one empty; a text all of whose lines go becomes
    empty, one without two lines that are not blank stays. Equal rows (same id and text) are one row to the ranking: they keep and lose the same lines.
    An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    spans, row, key, gone, unit, lost = free(docs, "spans", "row", "key", "gone", "unit", "lost")
    cut = removed_units(docs, id_col, text_col).withColumnsRenamed({"_key": key, "_gone": gone})
    # the caller's columns travel as one struct, so no name clashes
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), both_keys(id_col, text_col).alias(key))
    met = keyed.join(cut, key, "left")
    text = F.col(row)[text_col]
    met = met.select(row, F.when(F.col(gone).isNotNull(), F.transform(units(text), lambda u: u["i"])).alias(unit),
                     F.array_sort(F.array_distinct(F.flatten(F.transform(gone, lambda g: F.sequence(g["from"], g["to"]))))).alias(lost))
    lines, n = F.split(text, "\n"), F.size(F.split(text, "\n"))
    start, after = lambda j: F.get(unit, j), lambda j: F.coalesce(F.get(unit, j + 1), n)
    stay = F.array_except(F.sequence(F.lit(0), F.size(unit) - 1), lost)
    kept = F.array_join(F.concat(F.slice(lines, F.lit(1), F.get(unit, F.lit(0))), F.flatten(F.transform(
        stay, lambda j: F.slice(lines, start(j) + 1, after(j) - start(j))))), "\n")
    first = F.filter(lost, lambda j, t: (t == 0) | (F.get(lost, t - 1) < j - 1))
    last = F.filter(lost, lambda j, t: (t == F.size(lost) - 1) | (F.get(lost, t + 1) > j + 1))
    found = F.zip_with(first, last, lambda a, b: F.struct(start(a).alias("start"), (after(b) - start(a)).alias("lines")))
    new_text = F.when(F.col(lost).isNull(), text).otherwise(kept)
    return met.select(*[(new_text if c == text_col else F.col(row)[c]).alias(c) for c in docs.columns], found.alias(spans))


def op10_line_chunks(spark, sf_dir: str) -> DataFrame:
    """Whole documents without passages of lines that stand earlier in the corpus: what went, and the digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).alias("n_lines"))
    out = dedup_lines(docs)
    return out.select(
        "doc_id", F.coalesce(F.when(F.col("n_lines") < 0, None).otherwise(F.col("n_lines")), F.lit(0)).cast("long").alias("n_lines"),
        F.expr("aggregate(coalesce(spans, array()), 0L, (n, s) -> n + s.lines)").alias("n_removed"),
        F.coalesce(F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("+"), s["lines"].cast("string"))), ","), F.lit("")).alias("removed"),
        F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = f"""
WITH l AS (SELECT doc_id, row_number() OVER () AS r, text, string_split(text, chr(10)) AS ls FROM documents),
u AS (SELECT *, list_filter(range(0, len(ls)), lambda i: trim(ls[i + 1], chr(32) || chr(9) || chr(10) || chr(13)) <> '') AS ui FROM l),
x AS (SELECT *, list_transform(ui, lambda i: ls[i + 1]) AS us, len(ui) AS n FROM u),
h AS (SELECT *, list_transform(us, lambda s: ('0x' || substr(md5(s), 1, 8))::BIGINT) AS hs FROM x WHERE n > 1),
m AS (SELECT r, doc_id, us, n, list_reduce(list_prepend([-1], list_transform(list_filter(range(0, n), lambda i:
  ('0x' || substr(md5(CASE WHEN i = 0 THEN '' ELSE hs[i]::VARCHAR END || ':' || hs[i + 1]), 1, 8))::BIGINT % {SPARSE} = 0), lambda i: [i])),
  lambda a, c: CASE WHEN c[1] - a[-1] >= 2 THEN list_concat(a, c) ELSE a END) AS es FROM h),
b AS (SELECT *, list_append(list_filter(es, lambda c: c = -1 OR c < n - CASE WHEN es[-1] = n - 2 THEN 2 ELSE 1 END), n - 1) AS cs FROM m),
c AS (SELECT r, doc_id, k, cs[k] + 1 AS f, cs[k + 1] AS t, array_to_string(us[cs[k] + 2:cs[k + 1] + 1], chr(10)) AS body,
  list_reverse(us[cs[greatest(k - 2, 1)] + 2:cs[k] + 1]) AS bef, us[cs[k + 1] + 2:coalesce(cs[k + 3], n - 1) + 1] AS aft FROM (SELECT *, unnest(range(1, len(cs))) AS k FROM b)),
o AS (SELECT *, row_number() OVER w AS place, first_value(bef) OVER w AS fb, first_value(aft) OVER w AS fa FROM c WINDOW w AS (PARTITION BY body ORDER BY doc_id, r, k)),
z AS (SELECT *, list_transform(range(1, least(len(bef), len(fb)) + 1), lambda i: bef[i] = fb[i]) AS zb, list_transform(range(1, least(len(aft), len(fa)) + 1), lambda i: aft[i] = fa[i]) AS za
  FROM o WHERE place > 1),
d AS (SELECT DISTINCT r, unnest(range(f - coalesce(nullif(list_position(zb, false), 0) - 1, len(zb)), t + coalesce(nullif(list_position(za, false), 0) - 1, len(za)) + 1)) AS j FROM z),
y AS (SELECT x.r, j, ui[j + 1] AS a, coalesce(ui[j + 2], len(ls)) AS e FROM d JOIN x USING (r)),
g AS (SELECT r, sum(n)::BIGINT AS n_removed, string_agg(a || '+' || n, ',' ORDER BY a) AS removed
  FROM (SELECT r, min(a) AS a, max(e) - min(a) AS n FROM (SELECT *, j - row_number() OVER (PARTITION BY r ORDER BY j) AS run FROM y) GROUP BY r, run) GROUP BY r),
gone AS (SELECT r, unnest(range(a, e)) AS i FROM y),
v AS (SELECT r, i, ls[i + 1] AS line FROM (SELECT r, ls, unnest(range(0, len(ls))) AS i FROM l)),
w AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS body FROM v ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed, '') AS removed,
  sha256(CASE WHEN text IS NULL THEN NULL ELSE coalesce(w.body, '') END) AS kept_sha256
FROM l LEFT JOIN g USING (r) LEFT JOIN w USING (r)
"""
