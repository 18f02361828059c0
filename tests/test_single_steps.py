"""Texts are built once and tokens sorted once; the cheaper forms give what the patterns gave."""

from pagelens.functions import html as H
from pagelens.functions import text as T
from pagelens.operators import blocks as B
from pagelens.operators import export as X
from pyspark.sql import functions as F


def plan(df, kind="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


def test_block_text_is_built_once(spark):
    pages = spark.createDataFrame([(1, "<main><p>some words that are long enough</p></main>")], "page_id bigint, html string")
    blocks = B.block_filters(B.block_rows(B.html_tokens(pages)), True)
    assert plan(blocks).count("array_join(") == 2  # one for the decoded pieces of a token, one for the tokens of a block
    assert [r.text for r in blocks.collect()] == ["some words that are long enough"]


def test_tokens_are_sorted_once(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>")], "page_id bigint, html string")
    assert plan(B.block_rows(B.main_content_scope(B.html_tokens(pages))), "executedPlan").count("Sort [page_id") == 1


def test_tags_are_stripped_once(spark):
    posts = spark.createDataFrame([("", "<b>" + "word " * 40 + "</b>")], "own string, html string")
    df = posts.select(T.excerpt("own", F.col("html")).alias("e"))
    assert plan(df).count("script|style") == 1
    assert df.first().e == " ".join(["word"] * 30) + "&hellip;"


def test_links_of_a_record_are_taken_once(spark):
    posts = spark.createDataFrame([(1, "page", "https://a.b/c", "t", "publish", "2024-01-01 00:00:00", "2024-01-01 00:00:00", "", '<a href="/x">y</a>')],
                                  "id bigint, post_type string, url string, post_title string, post_status string, post_date string, post_modified string, post_excerpt string, post_content string")
    rec = X.export_record(posts).select("internal_count", "external_count", "excerpt")
    assert plan(rec).count("<a[^>]+href") == 2  # address and text
    assert tuple(rec.first()) == (1, 0, "y")


def test_excerpt_edges(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [None, "", " ", "a", " ".join(words[:30]), " \n".join(words[:31]), "\t".join(words), "\x0b" + " ".join(words[:30]) + " \x0b"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string").select("i", T.trim_words("t").alias("e"))
    full = " ".join(words[:30])
    assert [r.e for r in df.orderBy("i").collect()] == [None, "", "", "a", full, full + "&hellip;", full + "&hellip;", full]


def test_white_space_as_the_patterns(spark):
    rows = ["", " ", "a", " a\tb ", "a  b\n\n", "a b", "a  ", "a \u0085", "a \n ", "\x0c a\x0bb\r\n", "a  "]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    t = F.col("t")
    old = F.regexp_replace(F.regexp_replace(t, f"^{B.WS_CLASS}+|{B.WS_CLASS}+$", ""), f"{B.WS_CLASS}+", " ")
    new = B._one_space(B._trim_end(F.ltrim(t, F.lit(B.WS_CHARS))))
    assert df.filter(~old.eqNullSafe(new)).count() == 0


def test_headings_of_either_case(spark):
    df = spark.createDataFrame([(1, "<H2 class='x'>Big</h2><h2><b>small</b></H2>"), (2, "<p>none</p>"), (3, None)], "id int, h string")
    got = {r.id: (r.a, r.b) for r in df.select("id", H.headings("h", 2).alias("a"), H.headings("h", 3).alias("b")).collect()}
    assert got == {1: (["Big", "small"], []), 2: ([], []), 3: (None, None)}
