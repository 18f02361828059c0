"""The ten operators on small tables against plain Python: odd rows, ties, repeats, empty tables, clashing columns."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from pagelens.llm import bpe, decontaminate, language, line_dedup, quality, sharding, simhash, substring_dedup, token_counts, topk

DOCS = "doc_id long, text string"
LONG = "lorem ipsum dolor sit amet " * 30_000
ODD = [None, "", " \t\n ", "a", "Zürich ÉTÉ naïve 漢字 😀", "x" * 4000, "\n\n\n", "one two three four five six seven eight nine ten eleven twelve"]


def frame(spark, rows, schema=DOCS):
    """The rows beside columns whose names the operators use for themselves."""
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit(None).cast("string") for c in ("_key", "_text", "size", "shard", "n_words", "fp", "spans", "score", "lang", "x")})


def corpus(seed, n=60):
    draw = random.Random(seed)
    vocabulary = ["alpha", "beta", "gamma", "delta", "the", "of", "And", "éa", "x1", "zeta.", "omega,"]
    texts = ["\n".join(" ".join(draw.choices(vocabulary, k=draw.randint(1, 14))) for _ in range(draw.randint(1, 9))) for _ in range(n)]
    texts += draw.choices(texts, k=n // 3) + ODD
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + rows[:3] + [(None, texts[0]), (None, None), (5, "another text under an id that is taken")]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# -- 1 ---------------------------------------------------------------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def decontaminated(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    for doc, text in docs:
        w, hit, got = words(text), set(), set()
        for win, ids in windows.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    got |= ids
        yield doc, len(w), len(hit), sorted(str(g) for g in got if g is not None)


def test_decontamination(spark):
    docs = [r for r in corpus(1) if not r[1] or len(r[1]) < 3000]
    items = [(1, docs[4][1]), (2, "the of"), (2, docs[7][1]), (3, None), (4, ""), (None, "gamma the"), (5, "alpha beta gamma delta the"), (6, ODD[-1]), (7, ODD[-1])]
    got = decontaminate.hits(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    n_hit = F.expr("aggregate(spans, 0, (n, x) -> n + x.end - x.start)")
    got = got.select("doc_id", "n_words", n_hit.alias("h"), "items", F.explode(F.expr("sequence(1L, _copies)")))
    assert rows_of(got, "doc_id", "n_words", "h", "items") == sorted(decontaminated(docs, items), key=repr)


def test_decontamination_keeps_clean_rows_and_their_columns(spark):
    docs = frame(spark, [(1, "clean text"), (2, ODD[-1]), (2, ODD[-1]), (None, None)])
    items = spark.createDataFrame([(9, "TWO three; four five six seven eight nine ten ELEVEN")], "item_id long, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and rows_of(kept, "doc_id") == [(1,), (None,)]
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == 4
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0


def test_winnowing_keeps_a_gram_of_every_long_shared_span():
    draw = np.random.default_rng(3)
    text = draw.integers(0, 5, 400).astype(np.uint64)  # few words: many equal hashes
    owner = np.zeros(400, np.int64)
    at, _ = decontaminate.winnow(text, owner, decontaminate.K, decontaminate.SPAN - decontaminate.K + 1)
    for i in range(391):
        assert any(i <= p <= i + decontaminate.SPAN - decontaminate.K for p in at)


# -- 2 and 8 ---------------------------------------------------------------------------------------------------------

STRINGS = ODD + [LONG, "<|endoftext|>", "x<|endoftext|><|startoftext|> y'll", "İSTANBUL ΣΑΣ ǆ Ᲊx １２", "áḅ̇ \x1c\x85　z",
                 "aaaa" * 2000 + "!!!!" * 500, "don't  we'LL\n\n it's  "]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = list(enumerate(STRINGS)) + [(0, None), (None, "a b"), (3, "a")]
    expected = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=repr)
    got = bpe.encode(frame(spark, rows).repartition(3), path)
    assert rows_of(got, "doc_id", "ids") == expected
    assert rows_of(got, "doc_id", "decoded") == sorted(((i, library.decode(ids, skip_special_tokens=False)) for i, ids in expected), key=repr)
    assert bpe.encode(frame(spark, rows).limit(0), path).count() == 0


def test_bpe_packs_of_any_size(spark, monkeypatch):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    monkeypatch.setattr(bpe, "PACK_WORDS", 40)
    monkeypatch.setattr(bpe, "PIECE_WORDS", 9)
    rows = [r for r in corpus(2) if r[0] is not None]
    got = bpe.encode(spark.createDataFrame(rows, DOCS).repartition(4), path)
    assert rows_of(got, "doc_id", "ids") == sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=repr)


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    draw = random.Random(8)
    noise = ["".join(draw.choices("aAé ß\n\t'sll12½!.—“İ漢́😀", k=draw.randint(1, 80))) for _ in range(300)]
    rows = list(enumerate(STRINGS + noise)) + [(None, "x y")]
    got = token_counts.token_counts(frame(spark, rows), path)
    assert rows_of(got, "doc_id", "n_bytes", "n_tokens") == sorted(
        ((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=repr)


# -- 3 ---------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("scale", [64, 1])
def test_top_k(spark, monkeypatch, scale):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "ROW_BLOCK", 8)
    draw = random.Random(scale)
    rows = [(i, [draw.choice([0.1, 0.5, -0.3, 2.0]) for _ in range(3)]) for i in range(50)]
    rows += [(60, None), (61, [None, 1.0]), (62, [math.nan]), (None, [1.0]), (80, [math.inf]), (64, []), (65, [1.0]), (65, [1.0]), (100, [1.0, 2.0, 3.0]),
             (40, [0.5, 2.0, 0.1]), (100, [1.0, 2.0, 3.0]), (100, [2.0, 2.0, -0.3]), (7, [2.0, 2.0, 2.0])]
    vectors = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = []
    for n, (q, v) in enumerate(vectors):
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), c) for m, (c, w) in enumerate(vectors) if m != n)[:7]
            expected += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit(1), "_v": F.lit(1), "score": F.lit(0)})
    got = topk.top_k(df, lambda i: i % 20 == 0, 7, scale=scale)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)
    assert topk.top_k(df.limit(0), lambda i: i % 20 == 0, 7).count() == 0


def best_by_numpy(vectors, k):
    """Rows of the k best other vectors of each whose id is divisible by 20; scores wrap at 64 bits."""
    data, out = np.array([v for _, v in vectors], np.int64), []
    score = data @ data.T
    for n, (q, _) in enumerate(vectors):
        if q % 20 == 0:
            best = sorted((-int(score[n, m]), c) for m, (c, _) in enumerate(vectors) if m != n)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("scale, k", [(1, 9), (64, 1), (64, 400), (10 ** 6, 9), (2 ** 40, 9)])
def test_top_k_over_many_blocks(spark, monkeypatch, scale, k):
    # scores in floats, doubles and wrapping integers, in tiles of a few pairs; a third of the vectors are one vector, so ties cross parts and blocks
    for name, value in (("QUERY_BLOCK", 4), ("ROW_BLOCK", 16), ("TILE", 32), ("PARTS", 3)):
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(5)
    ids = draw.permutation(300)
    data = draw.normal(size=(300, 6)).astype(np.float32)
    data[::3] = data[0]
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, data)]
    vectors = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, lambda i: i % 20 == 0, k, scale=scale)
    assert rows_of(got, "query_id", "rank", "vec_id", "score") == best_by_numpy(vectors, k)


def test_top_k_grid_is_not_broadcast(spark, monkeypatch):
    # the pairs of blocks are many times the table: Spark sizes them as the table, so nothing of them may be left to its choice of joins
    for name, value in (("QUERY_BLOCK", 2), ("ROW_BLOCK", 8)):
        monkeypatch.setattr(topk, name, value)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        draw = np.random.default_rng(6)
        vectors = [(i, [float(x) for x in draw.integers(-9, 9, 4)]) for i in range(100)]
        df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
        got = topk.top_k(df, lambda i: i % 20 == 0, 5, scale=1)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == best_by_numpy(vectors, 5)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "Generate" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("size", [4, 100])
def test_top_k_blocks_are_bounded(monkeypatch, size):
    # a wide vector among short ones: padded blocks stay under the bound, or hold one row
    monkeypatch.setattr(topk, "BLOCK_COMPONENTS", 64)
    widths = [3] * 30 + [50, 200] + [5] * 9
    rows = pa.table({"_id": range(len(widths)), "_v": [[1] * w for w in widths]})
    runs = [[w for b in run for w in pc.list_value_length(b.column("_v")).to_pylist()] for run in topk._runs(rows.to_batches(7), size)]
    assert [w for run in runs for w in run] == widths
    assert all(len(run) <= size and (len(run) == 1 or len(run) * max(run) <= 64) for run in runs)


# -- 4 ---------------------------------------------------------------------------------------------------------------

def test_unit_dedup(spark):
    docs = corpus(4) + [(900, "It begins here. " + ODD[-1] + ". And ends."), (901, ODD[-1].upper() + ".\nMore"), (902, LONG)]
    seen, kept = {}, {}
    # the earliest occurrence: by id, a null id last; equal rows are one row
    for i, t in sorted(dict.fromkeys(docs), key=lambda r: (r[0] is None, r[0] or 0, sharding_key(spark, r) if r[0] in (None, 5) else 0)):
        parts = []
        for a, e in substring_dedup.units(t or ""):
            w = t[a:e].lower().split()
            if len(w) < substring_dedup.MIN_WORDS or seen.setdefault(" ".join(w).rstrip(".!?"), (i, t, a)) == (i, t, a):
                parts.append(t[a:e])
        kept[i, t] = "".join(parts) if t is not None else None
    got = substring_dedup.dedup_units(frame(spark, docs), min_words=substring_dedup.MIN_WORDS)
    assert rows_of(got, "doc_id", "text") == sorted(((i, kept[i, t]) for i, t in docs), key=repr)
    for r in got.filter("doc_id IN (900, 901)").collect():
        assert r.n_removed == 1
    assert substring_dedup.dedup_units(frame(spark, docs).limit(0)).count() == 0


def test_short_units_go_with_their_passage(spark):
    license = "licensed under the apache license, version 2.0."
    verse = " ".join(f"Line {k} is short. So is {k} more!" for k in range(12))  # over 50 words, no sentence of eight
    japanese = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所で泣いていた事だけは記憶している。"
    copy = f"Title\n\n- one item\n- two items\n{ODD[-1]}. Yes. No.\n短い行\nend"
    junk = "spam. " * 300
    docs = [(1, f"first\n{license}\nof all"), (2, f"{license.upper()}\nsecond"), (3, f"One begins here. {verse} And it ends."),
            (4, f"Another start stands before. {verse} Then others follow."), (5, japanese), (6, "前置きです。" + japanese + "後書きである。"),
            (7, copy), (8, copy), (9, junk), (10, junk), (11, "A yes. Yes. Quite so. No."), (12, None), (13, ""), (14, f"{license}\n{license}")]
    got = {r.doc_id: r for r in substring_dedup.dedup_units(frame(spark, docs).repartition(3), passages=True).collect()}
    text = {i: t for i, t in docs}
    for i in (1, 3, 5, 7, 11, 12, 13):
        assert got[i].text == text[i] and got[i].n_removed == 0
    assert got[2].text == "second" and got[14].text == ""
    assert got[4].text == "Another start stands before. Then others follow."
    assert got[6].text == "前置きです。後書きである。"
    assert got[8].text == "" and got[8].n_removed == got[8].n_units
    assert got[9].text.split() == ["spam."] and got[10].text == ""
    for r in got.values():  # what stays and what went together are the text
        stay, at = [], 0
        for s in r.spans:
            stay.append(text[r.doc_id][at:s["start"]])
            at = s["end"]
        assert text[r.doc_id] is None or "".join(stay) + text[r.doc_id][at:] == r.text
    plain = {r.doc_id: r.text for r in substring_dedup.dedup_units(frame(spark, docs)).collect()}
    assert plain[2] == text[2] and plain[4] == text[4]


def repeated_by_hand(spark, docs, run_words):
    """The texts that stay, by (id, text), found with whole keys instead of digests."""
    least, mark = substring_dedup.MIN_WORDS, ".!?。！？｡"
    found, parts = {}, {}
    for i, t in dict.fromkeys(docs):
        of = [t[a:e] for a, e in substring_dedup.units(t or "")]
        said = [substring_dedup.words(u) for u in of]
        full = [n for n, w in enumerate(said) if w]
        places = [((n,), ("unit", trim(" ".join(of[n].lower().split()), mark))) for n in full if len(said[n]) >= least]
        line = []
        for n in full:
            line.append(n)
            if of[n].endswith("\n") or n == full[-1]:
                if sum(min(len(said[k]), least) for k in line) < least:
                    places.append((tuple(line), ("line", trim(" ".join("".join(of[line[0]:n + 1]).lower().split()), mark))))
                line = []
        spans = set()
        for at, n in enumerate(full):
            if len(said[n]) < least:
                for step in (1, -1):
                    got, end = len(said[n]), at
                    while got < least and 0 <= end + step < len(full):
                        end += step
                        got += len(said[full[end]])
                    if got >= least:
                        spans.add((min(at, end), max(at, end)))
        for a, b in spans:
            inner = [w for k in full[a + 1:b] for w in said[k]]
            key = ("run", tuple(min(len(said[k]), least) for k in full[a:b + 1]),
                   trim(" ".join([*said[full[a]][-least:], *inner, *said[full[b]][:least]]), mark))
            places.append((tuple(k for k in full[a:b + 1] if len(said[k]) < least or a < full.index(k) < b), key))
        parts[i, t] = of, full
        order = (i is None, i or 0, sharding_key(spark, (i, t)))
        for place, key in places:
            found.setdefault(key, set()).add((order, place[0], len(place), place, (i, t)))
    gone = {}
    for key, places in found.items():
        for *_, place, row in sorted(places, key=lambda p: p[:3])[1:]:
            gone.setdefault(row, set()).update(range(place[0], place[-1] + 1))
    kept = {}
    for row, (of, full) in parts.items():
        out, lost = set(), gone.get(row, set())
        for first in full:
            run = [first]
            if first in lost and not (full.index(first) and full[full.index(first) - 1] in lost):
                run = list(itertools.takewhile(lost.__contains__, full[full.index(first):]))
                if len(run) == len(full) or sum(len(substring_dedup.words(of[k])) for k in run) >= run_words:
                    out.update(n for n in lost if run[0] <= n <= run[-1])
        kept[row] = "".join(u for n, u in enumerate(of) if n not in out) if row[1] is not None else None
    return kept


def trim(text, mark):
    return text.rstrip(mark) or text


def test_only_long_runs_go(spark):
    shared = " ".join(f"Part {k} of the shared notice is told here again." for k in range(6))
    lone = "This one sentence of more than eight words stands in many documents."
    code = "def one(x):\n    y = x + 1\n    return x\n}\n"
    verse = "\n".join(f"line {k} of it" for k in range(9))
    docs = corpus(6)[:60] + [(700, f"Introduction\nFirst text of its own kind. {shared} Its end."), (701, f"Introduction\nAnother beginning. {lone} {shared}\nOther end."),
                             (702, f"{lone} With its own words after it."), (703, code + "first of its kind"), (704, "something else\n" + code), (705, lone), (706, lone),
                             (707, verse + "\nOne more."), (708, "Before it.\n\n" + verse.replace("\n", "\n\n") + "\n\nAfter it."), (709, "\n \n"), (710, ""), (711, None), (706, lone)]
    got = substring_dedup.dedup_units(frame(spark, docs).repartition(3), passages=True, run_words=25)
    kept = repeated_by_hand(spark, docs, 25)
    assert rows_of(got, "doc_id", "text") == sorted(((i, kept[i, t]) for i, t in docs), key=repr)
    text = {r.doc_id: r.text for r in got.collect()}
    assert "shared notice" not in text[701] and lone in text[701] and text[701].startswith("Introduction")
    assert text[702].startswith(lone) and text[704] == "something else\n" + code and text[706] == ""
    assert "line 4 of it" not in text[708] and text[711] is None
    assert substring_dedup.dedup_units(frame(spark, docs).limit(0), passages=True, run_words=25).count() == 0


def sharding_key(spark, row):
    from pagelens.llm.common import row_key
    return spark.createDataFrame([row], DOCS).select(row_key("doc_id", "text")).first()[0]


# -- 5 ---------------------------------------------------------------------------------------------------------------

def test_sharding_law_slots_and_sizes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    docs = corpus(5, 300) + [(7777, "again")] * 40
    got = sharding.shard_rows(frame(spark, docs), sharding.layout(16), sharding.layout(17)).collect()
    assert len(got) == len(docs)
    for _, g in itertools.groupby(sorted(got, key=lambda r: r.shard), key=lambda r: r.shard):
        slots = sorted(r.slot for r in g)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 16) for r in got) and any(r.grown_shard == 16 for r in got)
    assert all(len({r.shard for r in got if r.doc_id == i}) == 1 for i in (5, 7777, None))
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs), key=repr)
    assert sharding.shard_rows(frame(spark, docs).limit(0), sharding.layout(16)).count() == 0


def test_a_changed_weight_moves_rows_into_its_own_subtree_only(spark):
    ids = spark.range(4000)
    place = lambda tree: [r[0] for r in ids.select(sharding.descend(F.col("id").cast("string"), tree)).collect()]
    before, after = place(sharding.layout(16)), place(sharding.layout(16, weights={5: 3.0}))
    moved = [(a, b) for a, b in zip(before, after) if a != b]
    assert moved and all(b // 8 == 0 for _, b in moved)  # into the first region, which holds shard 5
    assert all(b // 4 == 1 for a, b in moved if a // 8 == 0)  # within it, into the rack of shard 5


# -- 6 ---------------------------------------------------------------------------------------------------------------

def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, max_bits):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= max_bits:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def test_simhash(spark):
    docs = corpus(6) + [(1000 + k, LONG[:4000] + " tail" * k) for k in range(12)]
    fps = {t: fingerprint(t) for _, t in docs}
    root = components(sorted(set(fps.values())), 4)
    least = {}
    for i, t in docs:
        if i is not None:
            least[root[fps[t]]] = min(i, least.get(root[fps[t]], i))
    got = simhash.near_duplicates(frame(spark, docs)).withColumn("h", F.lpad(F.lower(F.hex("fp")), 16, "0"))
    assert rows_of(got, "doc_id", "h", "component_id") == sorted(
        ((i, format(fps[t], "016x"), least.get(root[fps[t]])) for i, t in docs), key=repr)
    kept = simhash.keep_one(frame(spark, docs))
    assert rows_of(kept, "doc_id") == sorted(((i,) for i in least.values()), key=repr)
    assert simhash.near_duplicates(frame(spark, docs).limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [8, 4096])
def test_simhash_links_lose_no_component(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    draw = random.Random(chunk)
    fps = set()
    for _ in range(25):  # chains and balls of fingerprints a few bits apart, beside far ones
        f = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 30])):
            fps.add(f)
            for b in draw.sample(range(64), draw.randint(1, 5)):
                f ^= 1 << b
    fps |= {draw.getrandbits(12) for _ in range(60)}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    edges = [(r[0] % (1 << 64), r[1] % (1 << 64)) for r in simhash.links(df).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {f: find(f) for f in fps} == components(sorted(fps), 4)


# -- 7 and 9 ---------------------------------------------------------------------------------------------------------

def test_languages(spark):
    draw = random.Random(7)
    syllables = {"aa": ["ka", "to", "mi"], "bb": ["sch", "ung", "ß"], "cc": ["ção", "lh", "nh"]}
    rows = [(i, " ".join("".join(draw.choices(syllables[g], k=3)) for _ in range(draw.randint(5, 400))), g) for i in range(400) for g in [draw.choice("abc") * 2]]
    rows += [(1000, None, "aa"), (1001, "", None), (1002, "12 !!", "bb"), (None, rows[0][1], None), (1003, rows[0][1], None), (1003, rows[0][1], None)]
    df = spark.createDataFrame(rows, DOCS + ", lang string").withColumns({"score": F.lit("x"), "lang_pred": F.lit("x"), "_h": F.lit(1)})
    out = language.languages(df, language.learned).collect()
    lang = {i: g for i, _, g in rows}
    held = [(r.lang_pred, lang[r.doc_id]) for r in out if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(out) == len(rows) and len(held) > 50 and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id in (1000, 1001, 1002)} == {"und"}
    assert {r.lang_pred for r in out if r.doc_id in (1003, None)} == {rows[0][2]}
    assert language.languages(df.limit(0), language.learned).count() == 0
    assert {r.lang_pred for r in language.languages(df.withColumn("lang", F.lit(None).cast("string")), language.learned).collect()} == {"und"}


def test_every_language_is_learned(spark, monkeypatch):
    draw = random.Random(77)
    code = {f"l{k:03d}": "".join(draw.sample("abcdefghijklmnopqrstuvwxyz", 3)) for k in range(230)}
    rows = [(i, " ".join(code[g] for _ in range(30)), g) for i, g in enumerate([*code] * 4)]
    df = spark.createDataFrame(rows, DOCS + ", lang string")
    net = language.train(df, lambda i: i.isNotNull())
    assert net.labels == sorted(code) and net.p["s"].shape[1] == len(code)
    assert language.per_language(4) == 400 and language.per_language(230) == 80_000 // 230 and language.per_language(10 ** 6) == 1
    monkeypatch.setattr(language, "TRAIN_DOCS", 300)  # one document of each language, none left without
    assert language.train(df, lambda i: i.isNotNull()).labels == sorted(code)
    # a text of many parts weighs its windows as one of few does
    long = "".join(r[1] for r in rows[:500]) * 8
    cut = language.windows(long.encode())
    weight = np.minimum(language.WINDOW, len(long) - np.arange(len(cut)) * (language.WINDOW - max(language.WIDTHS) + 1))
    mean = np.average(net.probabilities(cut, net.tables()), axis=0, weights=weight)
    got = language.predict(["x", long, None, rows[0][1]], net, net.tables())
    assert got[0][1] == net.labels[mean.argmax()] and got[1][1] == pytest.approx(mean.max())


def test_language_windows_cover_the_text():
    for n in (1, 5, 255, 256, 257, 1000, 5000):
        data = bytes(range(97, 123)) * (n // 26 + 1)
        data = data[:n]
        cut = language.windows(data)
        step = language.WINDOW - max(language.WIDTHS) + 1
        assert bytes(np.concatenate([cut[0], *(c[-step:] for c in cut[1:])])[:n]) == data
        assert (len(cut) - 1) * step + max(language.WIDTHS) - 1 < n or len(cut) == 1


def test_quality(spark):
    draw = random.Random(9)
    good = lambda: " ".join(draw.choices(["the", "of", "river", "stone", "light", "over", "again", "we"], k=draw.randint(20, 200)))
    bad = lambda: draw.choice([lambda: "!! ".join(draw.choices("BUY NOW FREE".split(), k=40)), lambda: " ".join(["buy"] * 50)])()
    rows = [(i, good() if i % 3 else bad()) for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(250)] + [(0, 1, 0), (7, None, 0), (9999, 1, 0), (None, 1, 0)] + [(5, 1, 0)] * 3
    docs = frame(spark, rows + [(1000, None), (1001, ""), (None, good()), (5, rows[5][1])])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality.quality(docs, marks, quality.learned)
    got = out.collect()
    assert out.columns == [*docs.columns, "__score"] and len(got) == 304
    held = [(r["__score"] >= 0.5) == (r.doc_id % 3 > 0) for r in got if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 60 and np.mean(held) > 0.95
    assert all(0 <= r["__score"] <= 1 for r in got)
    assert {r["__score"] for r in quality.quality(docs, marks.limit(0), quality.learned).collect()} == {0.5}
    assert quality.quality(docs.limit(0), marks, quality.learned).count() == 0


def test_word_vectors_are_sums_over_all_neighbours(spark):
    texts = ["a b c a", "c, c b", None, "", "a a a"]
    got = quality.word_vectors(spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3))
    places, signs = quality.index_vectors()
    index = np.zeros((quality.BUCKETS, quality.DIMS))
    for k in range(quality.NONZERO):
        np.add.at(index, (np.arange(quality.BUCKETS), places[:, k]), signs[:, k])
    expected = np.zeros_like(index)
    for t in texts:
        ids = quality.words([(t or "").encode()])[0]
        assert len(ids) == len(re.findall(r"\w+|[^\w\s]+", t or ""))
        for i, w in enumerate(ids):
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if i != j:
                    expected[w] += index[ids[j]]
    expected /= np.maximum(np.linalg.norm(expected, axis=1, keepdims=True), 1)
    assert np.allclose(got, expected, atol=1e-6)


# -- 10 --------------------------------------------------------------------------------------------------------------

def chunks(lines):
    """(first, last, lines before, lines after) of every chunk of lines that are not blank."""
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    rolling = [int(hashlib.md5(f"{h[i - 1] if i else ''}:{h[i]}".encode()).hexdigest()[:8], 16) for i in range(len(h))]
    cuts = [-1]
    for i in range(len(h) - 1):
        if rolling[i] % line_dedup.SPARSE == 0 and i - cuts[-1] > 1:
            cuts.append(i)
    if len(cuts) > 1 and cuts[-1] == len(h) - 2:
        cuts.pop()
    cuts.append(len(h) - 1)
    for k in range(len(cuts) - 1 if len(h) > 1 else 0):
        far = cuts[k + 3] if k + 3 < len(cuts) else len(h) - 1
        yield cuts[k] + 1, cuts[k + 1], lines[cuts[max(k - 2, 0)] + 1:cuts[k] + 1], lines[cuts[k + 1] + 1:far + 1]


def agree(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def deduped(texts):
    """The texts (in order of rank) without passages of an earlier one."""
    seen, out = {}, []
    for t, text in enumerate(texts):
        lines = (text or "").split("\n")
        unit = [i for i, x in enumerate(lines) if x.strip(" \t\r\n")]
        gone = set()
        for a, b, before, after in chunks([lines[i] for i in unit]):
            body = "\n".join(lines[i] for i in unit[a:b + 1])
            first = seen.setdefault(body, (t, a, before, after))
            if first[:2] != (t, a):
                gone |= set(range(a - agree(before[::-1], first[2][::-1]), b + agree(after, first[3]) + 1))
        drop = {k for j in gone for k in range(unit[j], (unit + [len(lines)])[j + 1])}
        out.append(None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in drop))
    return out


def test_line_dedup(spark):
    shared = "\n".join(f"shared line {k} of many" for k in range(30))
    docs = corpus(10) + [(500 + k, f"head {k}\n" * k + shared + f"\ntail {k}") for k in range(6)] + [(600, "\n" * 50), (601, "\n" * 50)]
    docs += [(700 + k, "\n\n".join(f"paragraph {i * (1 if 3 < i < 12 else k)}" for i in range(16)) + "\n \n") for k in range(1, 4)]
    docs += [(800 + k, f"start {k}\n" + f"same {k % 4}\n" * (k + 2) + "end") for k in range(8)]
    order = sorted(dict.fromkeys(docs), key=lambda r: (r[0] is None, r[0] or 0, line_keys(spark, r) if r[0] in (None, 5) else 0))
    kept = dict(zip(order, deduped([t for _, t in order])))
    df = frame(spark, docs).withColumns({c: F.lit(1) for c in ("__key", "__gone", "_ROW", "key", "unit", "_x")})
    got = line_dedup.dedup_lines(df)
    assert got.columns == [*df.columns, "_spans"]
    assert rows_of(got, "doc_id", "text") == sorted(((i, kept[i, t]) for i, t in docs), key=repr)
    assert all(len(r.text) < 200 for r in got.filter("doc_id BETWEEN 501 AND 505").collect())  # whatever stands before it, the passage goes
    for r in got.filter("_spans IS NOT NULL").collect():
        spans = [tuple(s) for s in r["_spans"]]
        assert spans == sorted(spans) and all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def line_keys(spark, row):
    return tuple(frame(spark, [row]).select(line_dedup.both_keys("doc_id", "text").alias("k")).first().k)


def test_line_dedup_takes_whole_passages():
    draw = random.Random(10)
    line = lambda: " ".join(draw.choices("abcdefghijklmnop", k=9))
    for n, least in ((5, 0.35), (8, 0.7), (10, 0.85), (20, 0.98)):
        gone = 0
        for _ in range(300):
            passage = [line() for _ in range(n)]
            a, b = ([line() for _ in range(draw.randint(2, 9))] + passage + [line() for _ in range(draw.randint(2, 9))] for _ in range(2))
            left = deduped(["\n".join(a), "\n".join(b)])[1].split("\n")
            assert all(x in left for x in b if x not in passage)
            gone += n - sum(x in left for x in passage)
        assert gone / (300 * n) > least
