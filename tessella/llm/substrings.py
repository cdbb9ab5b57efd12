"""Substring dedup by a compacted De Bruijn graph of words.

An edge of the graph is a window of ``WIDTH`` consecutive words of one document; windows follow each other through the words that they
share. Only edges that also start in a document with a smaller doc_id matter, and they come in long paths without branches.

1. Pieces. Every text is cut into pieces: runs of windows that share an *anchor*, the ``GRAM`` words within the window whose hash is
   least, leftmost on ties. A piece is a path of the graph that is compact from the start, about one row for five windows. All
   occurrences of a window have the same anchor, so pieces of different anchors never share an edge. One shuffle deals the pieces
   by their anchor; window functions tell for each piece (equal words are one class) its first document, its copies, and whether
   other classes of the same anchor exist: there the graph may branch.
2. Paths. Piece B follows piece A without a branch if every occurrence of A ends where one of B starts and the other way round. Each
   class carries sums over hashes of the source coordinates where it starts, and of those where it ends, so this is an equi-join
   of ``ends`` with ``starts``. Pieces that are joined so lie next to each other in their first document, whose coordinates give the
   path its length and verify that it has no gap. The occurrences are then joined with the heads of paths: each yields the whole span.
3. Branches. Where classes of one anchor differ, their windows are compared one by one: the windows of each class's first document
   are hashed from the text and dealt by anchor and hash.
4. Spans of both kinds are merged in each document, and the words that they cover are removed.

Hot anchors (beyond one in ``PART`` of a sample of the documents) are spread over ``PIECES`` buckets; their classes are summed up by
partial aggregation instead, and hot classes are salted where they are joined. The sample decides about the way only, the result is
the same. Texts move twice: to the windows at branches, and to the spans.

Rows: a null text has no words; texts under ``WIDTH`` words lose nothing; a row without doc_id loses nothing and removes nothing; rows of
one doc_id, repeated rows included, don't remove each other's words; different texts of one doc_id are told apart by a 32-bit hash;
long texts are read whole; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import PART, PIECES, busy, cut, joined_apart, pick, table
from tessella.llm.words import STEP, Memo, batches, hold, mix, nothing, number, starts, windows

WIDTH, GRAM = 13, 4
#: One document in so many is looked at for hot anchors, of which so many rows must be found at least.
SAMPLE, SEEN = 64, 8

_numbers = Memo(number)

ROW = ["doc_id", "key"]


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, key, _text); doc_id and key stand for the row."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).bitwiseAND(0xFFFFFFFF).alias("key"), text.alias("_text"))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts' words in a row, and how many each text has."""
    split = [t.encode().split() for t in texts]  # of bytes: the six ASCII blanks
    n = np.array([len(w) for w in split], np.int64)
    return np.fromiter((_numbers[w] for words in split for w in words), np.uint64, int(n.sum())), n


def pieces(flat: np.ndarray, n: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, first window in it, windows, hash of the anchor, hash of the piece) of every piece of texts of ``n`` words in a row."""
    edges, grams = windows(flat, width), windows(flat, gram)
    every = np.arange(len(edges))
    least, anchor = grams[: len(edges)].copy(), every.copy()
    for s in range(1, width - gram + 1):
        less = grams[s : s + len(edges)] < least
        least[less] = grams[s : s + len(edges)][less]
        anchor[less] = every[less] + s
    start = np.flatnonzero(every + width <= np.repeat(np.cumsum(n), n)[: len(edges)])  # not across texts
    if not len(start):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    first = np.flatnonzero(np.append(True, anchor[start][1:] != anchor[start][:-1]))
    size = np.diff(np.append(first, len(start)))
    inside = (np.arange(len(start)) - np.repeat(first, size)).astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(mix(edges[start] + STEP * inside), first)
    at = start[first]
    text = np.searchsorted(np.cumsum(n), at, side="right")
    return text, at - starts(n)[text], size, least[at], whole


def runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(g, f, doc_id, key, at) of every piece: hashes of anchor and words, and the first window (all but 8 bits) with the number of windows."""
    if not 0 < gram <= width < 256:
        raise ValueError(f"a window of {width} words can't have anchors of {gram}")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("substrings", nothing)
        for pdf in parts:
            for some in batches(pdf):
                text, at, size, g, f = pieces(*_words(some["_text"].tolist()), width, gram)
                yield pd.DataFrame({"g": g.view(np.int64), "f": f.view(np.int64), "doc_id": some.doc_id.to_numpy()[text], "key": some.key.to_numpy()[text], "at": (at << 8) | size})
        _numbers.clear()

    return _texts(docs).where("doc_id IS NOT NULL").mapInPandas(run, "g bigint, f bigint, doc_id bigint, key bigint, at bigint")


def hot_anchors(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(busy_key): the anchors of more than one in ``PART`` pieces of a sample of the documents, so fewer than ``PART``."""
    some = cut(runs(docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE)) == 0), width, gram).groupBy("g").agg(F.count("*").alias("rows")), "sample")
    total = some.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return some.where((F.col("rows") * PART > total) & (F.col("rows") >= SEEN)).select(F.col("g").alias("busy_key"))


def _start() -> Column:
    return F.shiftright("at", 8)


def _size() -> Column:
    return F.col("at").bitwiseAND(255)


def _spot() -> Column:
    return F.struct("doc_id", "key", "at")


def _class() -> dict[str, Column]:
    """What is known of a class: its first occurrence, its last document, and sums over hashes of the coordinates where it starts and ends.

    A sum is of 28 bits a row, so it holds for 2^35 rows; two of them tell one set of coordinates from another.
    """
    of = lambda p, i: F.sum(F.shiftright(F.xxhash64("doc_id", "key", p), 28 * i).bitwiseAND((1 << 28) - 1))
    return {"first": F.min(_spot()), "last_id": F.max("doc_id")} | {f"{name}{i}": of(p, i) for name, p in (("starts", _start()), ("ends", _start() + _size())) for i in (0, 1)}


SUMS = ["starts0", "starts1", "ends0", "ends1"]
PIECE = ["f", "g", "doc_id", "key", "at"]


class Marks(NamedTuple):
    """The pieces whose anchor occurs in several documents, as far as they are needed."""

    copies: DataFrame  #: ``PIECE`` of what may be a copy of an earlier document's piece; the path's first document decides
    classes: DataFrame  #: f, g, first, last_id and ``SUMS`` of each class that several documents hold
    branches: DataFrame  #: ``PIECE`` and hot of the pieces of a class's first document, where other classes share the anchor
    few: DataFrame  #: (busy_key) of the hot classes


def marked(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> Marks:
    hot = F.col("busy_key").isNotNull()
    rows = runs(docs, width, gram).join(F.broadcast(hot_anchors(docs, width, gram)), F.col("g") == F.col("busy_key"), "left")
    # the rows of a hot anchor are dealt into buckets of their own
    bucket = F.when(hot, F.xxhash64("g", F.pmod(F.xxhash64("key", "at"), F.lit(PIECES)))).otherwise(F.col("g"))
    rows = rows.select(bucket.alias("bucket"), "f", *ROW, "at", F.when(hot, F.col("g")).alias("hot_g"))
    same, anchor = Window.partitionBy("bucket", "f"), Window.partitionBy("bucket")
    known = rows.withColumns({k: v.over(same) for k, v in _class().items()})
    known = known.withColumns({"branches": F.min("f").over(anchor) < F.max("f").over(anchor), "shared": F.min("doc_id").over(anchor) < F.max("doc_id").over(anchor)})
    later, repeated, lone = F.col("doc_id") > F.col("first.doc_id"), F.col("last_id") > F.col("first.doc_id"), _spot() == F.col("first")
    hot = F.col("hot_g").isNotNull()
    needed = F.col("shared") & (later | F.col("branches") | (lone & repeated))
    facts = {k: F.when(lone & repeated & ~hot, F.col(k)) for k in SUMS}
    out = known.where(hot | needed).withColumns(facts)
    out = out.select("f", F.coalesce("hot_g", "bucket").alias("g"), *ROW, "at", hot.alias("hot"), (F.col("branches") & ~later).alias("open"), later.alias("later"), *SUMS)
    out = cut(out, "pieces")
    spread, usual = out.where("hot").select(*PIECE, "open", "later"), out.where("NOT hot")
    every = cut(spread.groupBy("f", "g").agg(*[v.alias(k) for k, v in _class().items()]), "classes")
    few = cut(busy(spread, "f", spread.count()), "hot")
    # of each bucket only what lies in its first document may lie in the first document of all
    first = joined_apart(spread.where("NOT later").select(PIECE), every.select("f", "g", F.col("first.doc_id").alias("first_id")), ["f", "g"], few, F.xxhash64("key", "at"))
    lone = usual.where("starts0 IS NOT NULL").select("f", "g", _spot().alias("first"), *SUMS).dropDuplicates(["f", "g"])
    return Marks(
        usual.where("later").select(PIECE).unionByName(spread.select(PIECE)),
        lone.unionByName(every.where(repeated).select("f", "g", "first", *SUMS)),
        usual.where("open").select(*PIECE, "hot").unionByName(first.where("doc_id = first_id").select(*PIECE, F.lit(True).alias("hot"))),
        few,
    )


def paths(classes: DataFrame) -> DataFrame:
    """(f, g, first_id, key, start, windows) of every repeated path without branches: its first piece, and its place and length in its first document."""
    lone = cut(classes.select("f", "g", "first.*", *SUMS), "lone")
    before = lone.select(F.col("ends0").alias("starts0"), F.col("ends1").alias("starts1"), F.struct("f", "g").alias("before"))
    along = Window.partitionBy(*ROW).orderBy("at")
    # the piece before must be the one whose ends are this one's starts, and leave no gap
    follows = (F.lag(F.struct("f", "g")).over(along) == F.col("before")) & (F.lag(_start() + _size()).over(along) == _start())
    steps = lone.drop("ends0", "ends1").join(before, ["starts0", "starts1"], "left").withColumn("head", ~F.coalesce(follows, F.lit(False)))
    steps = steps.withColumn("path", F.sum(F.col("head").cast("int")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    found = steps.groupBy(*ROW, "path").agg(F.min_by(F.struct("f", "g", _start().alias("start")), "at").alias("head"), F.sum(_size()).alias("windows"))
    return found.select("head.f", "head.g", F.col("doc_id").alias("first_id"), "key", "head.start", "windows")


def branch_windows(docs: DataFrame, here: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, key, start) of the windows at branches that also start in an earlier document."""
    lists = here.groupBy(*ROW).agg(F.collect_set(F.struct("at", "g", "hot")).alias("open"))  # as many as a text's pieces at most
    joined = _texts(docs).join(lists.select(*ROW, *[F.col(f"open.{c}").alias(c) for c in ("at", "g", "hot")]), ROW)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("substrings", nothing)
        for pdf in parts:
            for some in batches(pdf):
                flat, n = _words(some["_text"].tolist())
                edges, sizes = windows(flat, width), [len(a) for a in some["at"]]
                at, text = np.concatenate(some["at"].tolist()), np.repeat(np.arange(len(some)), sizes)
                start, size = at >> 8, at & 255
                inside = np.arange(int(size.sum())) - np.repeat(starts(size), size)
                place, row = np.repeat(start, size) + inside, np.repeat(text, size)
                yield pd.DataFrame({
                    "g": np.repeat(np.concatenate(some.g.tolist()), size), "e": edges[starts(n)[row] + place].view(np.int64),
                    "doc_id": some.doc_id.to_numpy()[row], "key": some.key.to_numpy()[row], "start": place, "hot": np.repeat(np.concatenate(some.hot.tolist()), size),
                })
        _numbers.clear()

    edges = joined.mapInPandas(run, "g bigint, e bigint, doc_id bigint, key bigint, start bigint, hot boolean")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("key", "start"), F.lit(PIECES)).cast("int")).otherwise(0)
    found = cut(edges.withColumn("salt", salt).withColumn("one", F.min("doc_id").over(Window.partitionBy("g", "e", "salt"))).where("hot OR doc_id > one").drop("salt"), "edges")
    spread = found.where("hot").drop("one")
    least = spread.groupBy("e", "g").agg(F.min("doc_id").alias("one"))
    again = joined_apart(spread, least, ["e", "g"], busy(spread, "e", spread.count()), F.xxhash64("key", "start"))
    return found.where("NOT hot").unionByName(again).where("doc_id > one").select(*ROW, "start")


def _occurrences(pieces: DataFrame, marks: Marks) -> DataFrame:
    """``pieces`` with the number of windows of the path that begins at them and its first document; null for pieces within a path."""
    whole = paths(marks.classes).select("f", "g", "first_id", "windows")
    return joined_apart(pieces, whole, ["f", "g"], marks.few, F.xxhash64("key", "at"), "left").withColumn("start", _start())


def repeated_paths(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(path, doc_id, key, start, words): the first occurrence of each repeated path without branches, and all in later documents."""
    marks = marked(pick(docs, "doc_id", "text"), width, gram)
    firsts = marks.classes.select("f", "g", "first.*")
    found = _occurrences(marks.copies.unionByName(firsts), marks).where("windows IS NOT NULL")
    return found.select(F.xxhash64("g", "f").alias("path"), *ROW, "start", (F.col("windows") + width - 1).alias("words")).distinct()


def _lists(docs: DataFrame, width: int, gram: int) -> DataFrame:
    """(doc_id, key, start, windows): of each document, the runs of windows that also start in an earlier document."""
    marks = marked(docs, width, gram)
    span = F.struct("start", "windows")
    spans = _occurrences(marks.copies, marks).select(*ROW, F.when(F.col("doc_id") > F.col("first_id"), span).alias("span"))
    single = branch_windows(docs, marks.branches, width).select(*ROW, F.struct("start", F.lit(1).cast("bigint").alias("windows")).alias("span"))
    return spans.unionByName(single).groupBy(*ROW).agg(F.collect_set("span").alias("found")).select(*ROW, F.col("found.start").alias("start"), F.col("found.windows").alias("windows"))


def remove_repeated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, spans array<bigint>, kept, kept_sha256) of every row.

    ``spans`` has first and last (exclusive) word of each removed run in turn; ``kept`` are the other words joined by spaces, if ``with_text``.
    """
    docs = pick(docs, "doc_id", "text")
    joined = _texts(docs).join(_lists(docs, width, gram), ROW, "left").select("doc_id", "_text", "start", "windows")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, parts):
            out = []
            for doc_id, text, start, size in zip(pdf.doc_id, pdf["_text"], pdf.start, pdf.windows, strict=True):
                words = text.encode().split()
                spans: list[int] = []
                if start is not None and len(start):
                    order = np.argsort(start, kind="stable")
                    first, last = start[order], np.maximum.accumulate((start + size)[order] + width - 1)
                    new = np.flatnonzero(np.append(True, first[1:] > last[:-1]))
                    spans = np.stack([first[new], last[np.append(new[1:], len(first)) - 1]], 1).ravel().tolist()
                edges = [0, *spans, len(words)]
                kept = b" ".join([b" ".join(words[a:b]) for a, b in zip(edges[::2], edges[1::2], strict=True) if a < b])
                out.append((doc_id, len(words), spans, kept.decode() if with_text else None, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "spans", "kept", "kept_sha256"]).astype({"doc_id": "Int64"})

    return joined.mapInPandas(run, "doc_id bigint, n_words bigint, spans array<bigint>, kept string, kept_sha256 string")


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows that start in an earlier one, as sizes and a digest."""
    out = remove_repeated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("sign")), lambda s, x: F.struct((s["n"] + s["sign"] * x).alias("n"), (-s["sign"]).alias("sign")), lambda s: s["n"])
    return out.select("doc_id", "n_words", removed.alias("n_removed"), "kept_sha256")
