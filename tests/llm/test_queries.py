"""The registered queries: contract columns, DuckDB SQL, the pipeline's stages against plain Python."""

import hashlib
import re

import corpus_pipeline
import pytest
from conftest import SMALL
from oracle import duck_conn, duck_rows, normalize, spark_rows
from pagelens.llm import queries as registered

COLUMNS = {
    "op1": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op2": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op3": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op4": "doc_id bigint, n_units bigint, n_removed bigint, removed string, kept_sha256 string",
    "op5": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op6": "doc_id bigint, fingerprint string, component_id bigint",
    "op7": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op8": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op9": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10": "doc_id bigint, n_lines bigint, n_removed bigint, removed string, kept_sha256 string",
    "op11": "page_id bigint, host string, path string, rule string, verdict string",
    "op12": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
    "op13": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, name):
    df = registered.queries()[name](spark, SMALL)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name.split("_")[0]]
    columns, rows = spark_rows(df)
    if sql := registered.oracle_sql().get(name):
        assert normalize(columns, rows) == normalize(*duck_rows(duck_conn(SMALL), sql))
    elif not name.startswith(("op3", "op11", "op12")):
        assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_line_dedup_is_native(spark):
    plan = registered.queries()["op10_line_chunks"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pipeline(spark):
    from test_operators import components, deduped, fingerprint, words
    from tokenizers import Tokenizer

    import public_tokenizers
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_dedup", "benchmark_decontamination", "bpe_tokens"]
    kept = corpus_pipeline.quality_classifier(spark, docs, SMALL)
    assert kept.schema.names == docs.schema.names
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    marked = {r.doc_id: r.quality for r in labels.collect()}
    stay = {r.doc_id: r.text for r in kept.collect()}
    all_ids = [r.doc_id for r in docs.collect()]
    right = [(i in stay) == bool(marked[i]) for i in all_ids if i in marked]
    assert sum(right) / len(right) > 0.9

    stay = dict(zip(sorted(stay), deduped([stay[i] for i in sorted(stay)])))
    fps = {i: fingerprint(t) for i, t in stay.items()}
    root = components(sorted(set(fps.values())), 4)
    least = {}
    for i in stay:
        least[root[fps[i]]] = min(i, least.get(root[fps[i]], i))
    stay = {i: stay[i] for i in least.values()}
    windows = set()
    for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 9, 1))} if w else set()
    dirty = lambda w: any(tuple(w[k:k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    stay = {i: t for i, t in stay.items() if not dirty(words(t))}

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(stay)
    for r in got:
        assert r.ids == library.encode(stay[r.doc_id], add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_digests_follow_the_contract(spark):
    from pagelens.llm.bpe import digests
    got = digests(spark.createDataFrame([(1, [5, 70], "a b</w>"), (2, [], "")], "doc_id long, ids array<int>, decoded string")).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert [tuple(r) for r in got] == [(1, 2, sha("5 70"), sha("a b</w>")), (2, 0, sha(""), sha(""))]


def test_every_operator_has_a_query():
    assert sorted({int(n[2:].split("_")[0]) for n in registered.queries()}) == list(range(1, 14))
