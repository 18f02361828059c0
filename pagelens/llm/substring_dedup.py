"""Repeated units of text (lines and the sentences of lines), kept once in the corpus.

A unit ends at a line's end or after a lone ``.``, ``!`` or ``?`` before blanks, so a
passage is found wherever it stands in a line. Units are normalised (lower case,
blanks run together, no end mark), digests are grouped over the whole corpus, the earliest
occurrence stays and the others are cut out; their places in the original text are kept.
In scripts without spaces two characters (four in South-East Asian ones) count as a word.

A unit of fewer than MIN_WORDS words alone is too common to tell a repeat. With
``passages`` it goes with what it stands in: a line of fewer words has a digest too, and successive units that
together have MIN_WORDS words have one, so of a repeated run of units with MIN_WORDS words or more all go, however
short each is. Whatever goes, the same unit stands at an earlier place, so the first one stays.

A sentence that many documents share by chance, a heading or a closing brace is no passage. With ``run_words`` what
repeats only goes as part of a run of successive repeated units with that many words together (blank units between
them do not count), or where all of a document's units repeat.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelens.llm.common import prepare, row_key, table

MIN_WORDS = 8
#: Words that a run of repeated units must have for its removal by the registered query.
RUN_WORDS = 25
_END = re.compile(r"(?<=[^.!?\n][.!?])[ \t]+(?=[^ \t\n])|[。！？｡]+[」』”’）]*[ \t\u3000]*\n*|\n+")
_MARKS = ".!?。！？｡"
_TWO = r"\u3001-\u303f\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff01-\uff9f\U00020000-\U0003ffff"
_FOUR = r"\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff"
_UNSPACED = re.compile(f"[{_TWO}{_FOUR}]")
_PIECE = re.compile(rf"[{_TWO}]{{1,2}}|[{_FOUR}]{{1,4}}|[^\s{_TWO}{_FOUR}]+")
#: A place is the number of its first unit, then in the low bits how many units with words it has (MIN_WORDS at most).
BITS = 16


def units(text: str) -> list[tuple[int, int]]:
    """(start, end) of the units; together they are the whole text."""
    cuts = [m.end() for m in _END.finditer(text)]
    if not cuts or cuts[-1] != len(text):
        cuts.append(len(text))
    return list(zip([0, *cuts[:-1]], cuts)) if text else []


def words(unit: str) -> list[str]:
    """Lower-case words; text without spaces is cut by its characters."""
    low = unit.lower()
    return low.split() if low.isascii() or not _UNSPACED.search(low) else _PIECE.findall(low)


def digest(of: str, kind: bytes = b"") -> bytes:
    """128 bits of normalised text; different kinds never meet."""
    return hashlib.blake2b((of.rstrip(_MARKS) or of).encode(), digest_size=16, person=kind).digest()


def digests(text: str, min_words: int, passages: bool) -> list[tuple[int, bytes]]:
    """(place, digest) of all that may go."""
    of = units(text)
    every = [words(text[s:e]) for s, e in of]
    out = [(n << BITS | 1, digest(" ".join(text[of[n][0]:of[n][1]].lower().split()))) for n, p in enumerate(every) if len(p) >= min_words]
    if not passages:
        return out
    at = [n for n, p in enumerate(every) if p]
    parts = [every[n] for n in at]
    size = [min(len(p), min_words) for p in parts]

    def add(a: int, b: int, kind: bytes) -> None:
        """A run of units; of a long one at its edge only the nearest words count, and it decides for itself."""
        run = [*parts[a][-min_words:], *(w for p in parts[a + 1:b] for w in p), *parts[b][:min_words]] if a < b else parts[a]
        first, last = a + (size[a] == min_words), b - (size[b] == min_words)
        out.append((at[first] << BITS | (last - first + 1), digest(f"{size[a:b + 1]} {' '.join(run)}", kind)))

    first = 0
    for i, n in enumerate(at):
        if text[of[n][1] - 1] == "\n" or i == len(at) - 1:
            if sum(size[first:i + 1]) < min_words:
                line = " ".join(text[of[at[first]][0]:of[n][1]].lower().split())
                out.append((at[first] << BITS | (i - first + 1), digest(line, b"line")))
            first = i + 1
    for i, own in enumerate(size):
        if own == min_words:
            continue
        b, got = i, own
        while got < min_words and b < len(size) - 1:
            b += 1
            got += size[b]
        if got >= min_words:
            add(i, b, b"run")
        a, got = i, own
        while got < min_words and a:
            a -= 1
            got += size[a]
        if got - own >= min_words:  # else the run from unit a on ends here
            add(a, i, b"run")
    return out


def _unit_pass(min_words: int, passages: bool):
    def run(batches):
        for b in batches:
            row, number, found = [], [], []
            for i, text in enumerate(b.column(2).to_pylist()):
                for n, d in digests(text or "", min_words, passages):
                    row.append(i)
                    number.append(n)
                    found.append(d)
            halves = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(number, pa.int64()),
                                              pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())], names=["_id", "_key", "_unit", "_d1", "_d2"])
    return run


def _at(text: str, of: list[tuple[int, int]], place: int) -> range:
    """The units of a place, with blank ones between them."""
    first = last = place >> BITS
    left = (place & (1 << BITS) - 1) - 1
    while left:
        last += 1
        left -= not text[slice(*of[last])].isspace()
    return range(first, last + 1)


def _long_runs(text: str, of: list[tuple[int, int]], gone: set[int], run_words: int) -> set[int]:
    """Of the units that repeat, those in runs of ``run_words`` words or more; all, where every unit with words repeats."""
    out, run, got, whole = set(), [], 0, True
    for n, (s, e) in enumerate(of):
        if n in gone:
            run.append(n)
            got += len(words(text[s:e]))
        elif not text[s:e].isspace():
            if got >= run_words:
                out.update(run)
            run, got, whole = [], 0, False
    return gone if whole else out.union(run) if got >= run_words else out


def _cut_pass(run_words: int):
    def run(batches):
        for b in batches:
            kept, spans, counts, lost = [], [], [], []
            for text, gone in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                of = units(text or "")
                counts.append(len(of))
                gone = {n for place in gone or () for n in _at(text, of, place)}
                if gone and run_words:
                    gone = _long_runs(text, of, gone, run_words)
                lost.append(len(gone))
                if not gone:
                    kept.append(text)
                    spans.append([])
                    continue
                out, at, cut = [], 0, []
                for n in sorted(gone):
                    s, e = of[n]
                    out.append(text[at:s])
                    at = e
                    if cut and cut[-1]["end"] == s:
                        cut[-1]["end"] = e
                    else:
                        cut.append({"start": s, "end": e})
                kept.append("".join(out) + text[at:])
                spans.append(cut)
            span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.string()), pa.array(counts, pa.int32()),
                                              pa.array(lost, pa.int32()), pa.array(spans, span)],
                                             names=["doc_id", "text", "n_units", "n_removed", "spans"])
    return run


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   passages: bool = False) -> DataFrame:
    """``_key, _gone``: for each row that loses units, the places."""
    rows = docs.select(F.col(id_col).alias("_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    kinds = T.StructType([rows.schema["_id"], *T._parse_datatype_string("_key long, _unit long, _d1 long, _d2 long")])
    found = rows.mapInArrow(_unit_pass(min_words, passages), kinds)
    rank = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("i"), F.col("_key").alias("k"), F.col("_unit").alias("u"))
    repeated = found.groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n"), F.min(rank).alias("_first")).filter("_n > 1")
    later = found.select("_key", "_unit", "_d1", "_d2").join(repeated.select("_d1", "_d2", "_first"), ["_d1", "_d2"])
    later = later.filter((F.col("_first.k") != F.col("_key")) | (F.col("_first.u") != F.col("_unit")))
    return later.groupBy("_key").agg(F.collect_set("_unit").alias("_gone"))


def dedup_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                passages: bool = False, run_words: int = 0) -> DataFrame:
    """``doc_id, text, n_units, n_removed, spans`` of every row; spans are [start, end) characters of the original text.

    Occurrences rank by id (a null id last), then place. A null text has no units and
    stays null. Equal rows (same id and text) are one row to the ranking: they keep and
    lose the same units. An empty table gives an empty result. With ``run_words`` of 0 every repeated unit goes alone.
    """
    prepare(docs.sparkSession)
    gone = repeated_units(docs, id_col, text_col, min_words, passages).withColumnRenamed("_key", "_gone_key")
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("_key"), F.col(text_col).cast("string").alias("_text"))
    met = rows.join(gone, F.col("_key") == F.col("_gone_key"), "left").select("doc_id", "_text", "_gone")
    out = T.StructType([rows.schema["doc_id"], *T._parse_datatype_string(
        "text string, n_units int, n_removed int, spans array<struct<start:int,end:int>>")])
    return met.mapInArrow(_cut_pass(run_words), out)


def op4_unit_hashing(spark, sf_dir: str) -> DataFrame:
    """Whole documents without lines, sentences and passages that stand earlier in the corpus, and where those stood."""
    out = dedup_units(table(spark, sf_dir, "documents"), passages=True, run_words=RUN_WORDS)
    return out.select("doc_id", F.col("n_units").cast("long").alias("n_units"), F.col("n_removed").cast("long").alias("n_removed"),
                      F.array_join(F.transform("spans", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",").alias("removed"),
                      F.sha2("text", 256).alias("kept_sha256"))
