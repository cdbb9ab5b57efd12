"""Repeated passages by the common-prefix interval tree of a sparse enhanced suffix array.

A passage of ``LENGTH`` bytes that starts at two places holds the same *anchor* at both: of its ``GRAM``-byte grams, the one with
the least hash, leftmost on ties. So the suffixes that start at anchors, about one in 76 of all, show every repeat:

1. Every text is cut into runs of passages with one anchor. A run has the hash ``g`` of its anchor's gram and ``f`` of all its
   bytes. Grams that occur once are dropped by a count and a semi-join. Runs of equal (g, f) are copies and repeat in full; that is
   a partial aggregation, so a passage may occur in any share of all documents.
2. What is left are runs whose gram repeats but whose bytes as a whole don't: the edges of repeats. With one run of each copied
   class of the same gram they are the suffixes of the array. They are dealt by g, sorted by what follows the gram, and the stack
   scan of their common prefixes yields the intervals of the tree. Within an interval the suffixes are sorted by what stands
   before them; where neighbours' left extensions differ, the group splits, and what agrees for ``LENGTH`` bytes in both directions
   together is a maximal repeat, reported at all its occurrences.
3. A gram with more than ``HOT`` such classes isn't gathered: its passages are compared one by one, by 128-bit hashes that Spark
   counts and joins back; the result is the same.

Texts move once by their id, and again only where edges had to be compared. Rows: a null text is empty; texts under ``LENGTH``
bytes have no repeat; long texts are cut into pieces that overlap by a passage; rows that are repeated as a whole are copies of
each other; rows of one doc_id (or none) with different texts are told apart by a 128-bit hash; extra columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import KEYS, PART, cut, joined_apart, keyed, pick, table
from tessella.llm.words import batches, mix

LENGTH, GRAM = 200, 50
#: Grams in a passage, and the most bytes of it on either side of its anchor.
GRAMS = LENGTH - GRAM + 1
SIDE = GRAMS - 1
#: Classes of one gram that one task compares at most.
HOT = 50_000
#: Passages of a piece of a long text, and bytes of pieces that are worked on together.
PIECE, TOGETHER = 1 << 16, 1 << 18

_B = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.append(np.uint64(1), np.full(TOGETHER + 2 * PIECE, _B, np.uint64)), dtype=np.uint64)
_INVERSE = np.cumprod(np.append(np.uint64(1), np.full(TOGETHER + 2 * PIECE, pow(_B, -1, 2**64), np.uint64)), dtype=np.uint64)
_LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_PLACE = np.uint64((1 << 20) - 1)


def _runs(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """(start, passages, anchor, hash of the anchor's gram) of every run in the joined pieces."""
    joined = np.frombuffer(b"".join(pieces), np.uint8)
    n = len(joined) - GRAM + 1
    if len(joined) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_LETTERS[joined] * _POWERS[: len(joined)], out=sums[1:])
    h = mix((sums[GRAM:] - sums[:n]) * _INVERSE[:n])
    packed = (h & ~_PLACE) | np.arange(n, dtype=np.uint64)
    # least of each GRAMS neighbours: from the left in blocks and from the right in blocks
    blocks = np.append(packed, np.full(-n % GRAMS, 2**64 - 1, np.uint64)).reshape(-1, GRAMS)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    m = n - GRAMS + 1
    anchor = (np.minimum(back[:m], ahead[GRAMS - 1 : GRAMS - 1 + m]) & _PLACE).astype(np.int64)
    lengths = np.array([len(p) for p in pieces])
    starts = np.flatnonzero(np.repeat(np.cumsum(lengths), lengths)[:m] >= np.arange(m) + LENGTH)
    anchor = anchor[starts]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
    return starts[first], np.diff(np.append(first, len(anchor))), anchor[first], h[anchor[first]]


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, place in it, bytes), each together about ``TOGETHER`` bytes at most."""
    some, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), PIECE):
            part = t[at : at + PIECE + LENGTH - 1]
            if len(part) >= LENGTH:
                if size + len(part) > TOGETHER and some:
                    yield some
                    some, size = [], 0
                some.append((i, at, part))
                size += len(part)
    if some:
        yield some


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, row_k1, row_k2, _text); the row keys stand for the row where rows are joined and are never null."""
    return keyed(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), *KEYS, F.coalesce("text", F.lit("")).alias("_text"))


def runs(docs: DataFrame) -> DataFrame:
    """(g, f, row_k1, row_k2, at) of all runs; ``at`` packs start (40 bits), bytes in front of the anchor (8) and passages (8)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for some in batches(pdf):
                texts, keys = [t.encode() for t in some["_text"]], some[[*KEYS]].to_numpy(np.int64)
                for group in _pieces(texts):
                    start, n, anchor, g = _runs([p for *_, p in group])
                    joined = memoryview(b"".join([p for *_, p in group]))
                    f = [xxhash.xxh3_64_intdigest(joined[s:e]) for s, e in zip(start.tolist(), (start + n + LENGTH - 1).tolist(), strict=True)]
                    ends = np.cumsum([len(p) for *_, p in group])
                    piece = np.searchsorted(ends, start, side="right")
                    text = np.array([i for i, *_ in group])[piece]
                    place = start - np.append(0, ends)[piece] + np.array([a for _, a, _ in group])[piece]
                    at = (place << 16) | ((anchor - start) << 8) | n
                    yield pd.DataFrame({"g": g.view(np.int64), "f": np.array(f, np.uint64).view(np.int64), KEYS[0]: keys[text, 0], KEYS[1]: keys[text, 1], "at": at})

    return _texts(docs).select(*KEYS, "_text").mapInPandas(run, f"g bigint, f bigint, {KEYS[0]} bigint, {KEYS[1]} bigint, at bigint")


FULL, EDGE, BUSY = 1, 2, 4


def marked(docs: DataFrame) -> DataFrame:
    """(row_k1, row_k2, at, g, f, kind) of the runs that repeat in full (FULL) or must be compared (EDGE; with BUSY: passage by passage)."""
    every = runs(docs)
    grams = cut(every.groupBy("g").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    total = grams.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = grams.where(F.col("n") * PART > total).select(F.col("g").alias("busy_key"))
    again = cut(joined_apart(every, grams.select("g"), ["g"], hot, F.col("at"), "left_semi"), "runs")
    classes = again.groupBy("g", "f").agg(F.count("*").alias("n"), F.min(KEYS[0]).alias("one"))
    apart = classes.groupBy("g").agg(F.count("*").alias("classes"), F.min("n").alias("least")).where("classes > 1 AND least = 1").select("g", "classes")
    classes = cut(joined_apart(classes, apart, ["g"], hot, F.col("f"), "left"), "classes")
    common = classes.where(F.col("n") * PART > total).select(F.col("f").alias("busy_key")).distinct()
    joined = joined_apart(again, classes, ["f", "g"], common, F.col(KEYS[0]))
    edge = F.col("classes").isNotNull() & ((F.col("n") == 1) | (F.col(KEYS[0]) == F.col("one")))
    kind = F.when(F.col("n") > 1, FULL).otherwise(0) + F.when(edge, F.when(F.col("classes") > HOT, EDGE + BUSY).otherwise(EDGE)).otherwise(0)
    return joined.select(*KEYS, "at", "g", "f", kind.alias("kind")).where("kind > 0")


def _unpacked(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 16, (at >> 8) & 0xFF, at & 0xFF


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


#: Rows of the second pass over the texts: decided texts, texts with edges, and edges.
DECIDED, OPEN, CONTEXT = 0, 1, 2
SECOND = f"row int, doc_id bigint, {KEYS[0]} bigint, {KEYS[1]} bigint, body binary, spans array<bigint>, g bigint, kind int, start bigint, front binary, behind binary, n_bytes bigint, kept binary, kept_sha256 string"
DONE = ("doc_id", "n_bytes", "spans", "kept", "kept_sha256")


def _without(body: bytes, spans: list[int], with_text: bool) -> tuple[int, bytes | None, str]:
    """Bytes of a text, what is left of it without its spans (if asked for), and the digest of that."""
    places = [0, *spans, len(body)]
    kept = b"".join(body[a:b] for a, b in zip(places[::2], places[1::2], strict=True))
    return len(body), kept if with_text else None, hashlib.sha256(kept).hexdigest()


def _second(docs: DataFrame, marks: DataFrame, with_text: bool) -> DataFrame:
    lists = marks.groupBy(*KEYS).agg(F.collect_set(F.struct("at", F.when(F.col("kind").bitwiseAND(EDGE) > 0, F.col("g")).alias("g"), "kind")).alias("marks"))
    lists = lists.select(*KEYS, *[F.col(f"marks.{c}").alias(c) for c in ("at", "g", "kind")])  # as many as a text's runs at most
    joined = _texts(docs).join(lists, [*KEYS], "left")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for some in batches(pdf):
                out = []
                for doc_id, k1, k2, text, at, gs, kinds in zip(some.doc_id, some[KEYS[0]], some[KEYS[1]], some["_text"], some["at"], some.g, some.kind, strict=True):
                    body = text.encode()
                    doc_id = None if pd.isna(doc_id) else int(doc_id)
                    if at is None:
                        out.append((DECIDED, doc_id, k1, k2, None, [], None, 0, 0, None, None, *_without(body, [], with_text)))
                        continue
                    start, front, n = _unpacked(np.asarray(at, np.int64))
                    kinds = np.asarray(kinds)
                    full = (kinds & FULL) > 0
                    spans = _merged(list(zip(start[full].tolist(), (start + n + LENGTH - 1)[full].tolist(), strict=True)))
                    edges = np.flatnonzero((kinds & EDGE) > 0)
                    spans = [x for s in spans for x in s]
                    out.append((DECIDED, doc_id, k1, k2, None, spans, None, 0, 0, None, None, *_without(body, spans, with_text)) if full.all() else (OPEN, doc_id, k1, k2, body, spans, None, 0, 0, None, None, None, None, None))
                    for i in edges.tolist():
                        s, a, e = int(start[i]), int(start[i] + front[i]), int(start[i] + n[i]) + LENGTH - 1
                        out.append((CONTEXT, None, k1, k2, body[a : a + GRAM] if kinds[i] & BUSY else None, None, int(gs[i]), int(kinds[i]), s, body[s:a][::-1], body[a + GRAM : e], None, None, None))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in SECOND.split(", ")]).astype({"doc_id": "Int64", "g": "Int64", "n_bytes": "Int64"})

    return joined.mapInPandas(run, SECOND)


def _matrix(strings: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([s.ljust(SIDE, b"\0") for s in strings]), np.uint8).reshape(-1, SIDE)


def _common(m: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of rows a and b."""
    differ = m[a] != m[b]
    return np.minimum(np.where(differ.any(1), differ.argmax(1), SIDE), np.minimum(sizes[a], sizes[b]))


def intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the intervals of a suffix array whose neighbours i - 1 and i share lcp[i], children first."""
    stack = [(-1, 0)]
    for i in range(1, len(lcp) + 1):
        now, first = lcp[i] if i < len(lcp) else -1, i - 1
        while stack[-1][0] > now:
            depth, first = stack.pop()
            yield depth, first, i - 1
        if stack[-1][0] < now:
            stack.append((now, first))


def maximal_repeats(g: np.ndarray, front: list[bytes], behind: list[bytes]) -> tuple[np.ndarray, ...]:
    """(suffix, bytes in front, bytes behind, group, bytes in front that all of the group share) of each occurrence of a repeat.

    A repeat has ``LENGTH`` bytes or more around the gram; its group are the occurrences of one interval that agree so far. Several grams
    may come together.
    """
    right, left = _matrix(behind), _matrix(front)
    right_n, left_n = np.array([len(s) for s in behind]), np.array([len(s) for s in front])
    order = np.argsort(np.ascontiguousarray(right).view(f"S{SIDE}").ravel(), kind="stable")
    order = order[np.argsort(g[order], kind="stable")]
    lcp = np.append(-1, _common(right, right_n, order[1:], order[:-1]))
    lcp[1:][g[order[1:]] != g[order[:-1]]] = -1
    found = [[], [], [], [], []]

    def report(*columns: np.ndarray) -> None:
        for part, new in zip(found, columns, strict=True):
            part.append(new)

    cuts = np.append(np.flatnonzero(lcp < 0), len(lcp))
    two = cuts[:-1][np.diff(cuts) == 2]  # most grams have two suffixes: all pairs at once
    a, b = order[two], order[two + 1]
    before, after = _common(left, left_n, a, b), lcp[two + 1]
    good = before + after >= SIDE
    for side in (a, b):
        report(side[good], before[good], after[good], np.arange(int(good.sum())), before[good])
    groups = int(good.sum())
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if high - low < 3:
            continue
        members = order[low:high]
        by_left = np.argsort(np.ascontiguousarray(left[members]).view(f"S{SIDE}").ravel(), kind="stable")
        rank = np.empty(len(members), np.int64)
        rank[by_left] = np.arange(len(members))
        for depth, first, last in intervals([0, *lcp[low + 1 : high].tolist()]):
            inside = members[first : last + 1][np.argsort(rank[first : last + 1])]
            shared = _common(left, left_n, inside[1:], inside[:-1])
            if shared.max() + depth < SIDE:
                continue
            best = np.maximum(np.append(0, shared), np.append(shared, 0))  # the longest left extension with any other of the interval
            good = best + depth >= SIDE
            apart = shared + depth < SIDE  # neighbours whose left extensions differ too early are of different groups
            group = np.append(0, np.cumsum(apart))
            least = np.full(int(group[-1]) + 1, SIDE)
            np.minimum.at(least, group[1:][~apart], shared[~apart])
            report(inside[good], best[good], np.full(int(good.sum()), depth), groups + group[good], least[group[good]])
            groups += int(group[-1]) + 1
    return tuple(np.concatenate(part) if part else np.zeros(0, np.int64) for part in found)


EDGES = f"{KEYS[0]} bigint, {KEYS[1]} bigint, first bigint, last bigint, repeat bigint, start bigint"


def _edge_spans(contexts: DataFrame) -> DataFrame:
    """(row_k1, row_k2, first, last, repeat, start) of the repeats at edges, by the interval tree of each gram's suffixes.

    ``first`` and ``last`` are as wide as the occurrence agrees with any other; from ``start`` on all occurrences of ``repeat`` agree.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        front, behind, g = pdf.front.tolist(), pdf.behind.tolist(), pdf.g.to_numpy(np.int64)
        i, before, after, group, common = maximal_repeats(g, front, behind)
        anchor = pdf.start.to_numpy(np.int64)[i] + np.array([len(x) for x in front], np.int64)[i]
        repeat = mix(g[i].view(np.uint64) ^ mix(group.astype(np.uint64))).view(np.int64)  # a gram is in one call only
        return pd.DataFrame({KEYS[0]: pdf[KEYS[0]].to_numpy()[i], KEYS[1]: pdf[KEYS[1]].to_numpy()[i], "first": anchor - before, "last": anchor + GRAM + after, "repeat": repeat, "start": anchor - common})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in parts:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            going = pdf.g == pdf.g.iloc[-1]  # the last gram may go on in the next batch
            rest, now = pdf[going], pdf[~going]
            if len(now):
                yield solve(now.reset_index(drop=True))
        if rest is not None and len(rest):
            yield solve(rest.reset_index(drop=True))

    suffixes = contexts.where(F.col("kind").bitwiseAND(BUSY) == 0).select("g", *KEYS, "start", "front", "behind")
    return suffixes.repartition("g").sortWithinPartitions("g").mapInPandas(run, EDGES)


def _busy_spans(contexts: DataFrame) -> DataFrame:
    """The same for grams with very many classes: every passage by its hash."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for k1, k2, start, front, gram, behind in zip(pdf[KEYS[0]], pdf[KEYS[1]], pdf.start, pdf.front, pdf.body, pdf.behind, strict=True):
                text = front[::-1] + gram + behind
                for at in range(len(text) - LENGTH + 1):
                    h = xxhash.xxh3_128_digest(text[at : at + LENGTH])
                    out.append((int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), k1, k2, start + at))
            yield pd.DataFrame(out, columns=["h1", "h2", *KEYS, "first"])

    passages = contexts.where(F.col("kind").bitwiseAND(BUSY) > 0).select(*KEYS, "start", "front", "body", "behind")
    passages = cut(passages.mapInPandas(run, f"h1 bigint, h2 bigint, {KEYS[0]} bigint, {KEYS[1]} bigint, first bigint"), "passages")
    again = passages.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    return passages.join(again, ["h1", "h2"], "left_semi").select(*KEYS, "first", (F.col("first") + LENGTH).alias("last"), F.xxhash64("h1", "h2").alias("repeat"), F.col("first").alias("start"))


def repeat_groups(docs: DataFrame) -> DataFrame:
    """(repeat, doc_id, row_k1, row_k2, start, length): every occurrence of every repeated passage, grouped by ``repeat``.

    All occurrences of a ``repeat`` hold the same bytes: runs that are copied in full, and the maximal repeats of the interval tree at edges.
    Runs are cut at anchors, so a long copy is several groups in a row.
    """
    docs = pick(docs, "doc_id", "text")
    marks = cut(marked(docs), "marks")
    full = marks.where(F.col("kind").bitwiseAND(FULL) > 0)
    at = F.col("at")
    full = full.select(F.xxhash64("g", "f").alias("repeat"), *KEYS, F.shiftright(at, 16).alias("start"), (at.bitwiseAND(255) + LENGTH - 1).alias("length"))
    contexts = cut(_second(docs, marks, False), "texts").where(F.col("row") == CONTEXT)
    edges = _edge_spans(contexts).unionByName(_busy_spans(contexts)).select("repeat", *KEYS, "start", (F.col("last") - F.col("start")).alias("length"))
    rows = _texts(docs).select("doc_id", *KEYS).distinct()
    return full.unionByName(edges).distinct().join(rows, [*KEYS]).select("repeat", "doc_id", *KEYS, "start", "length")


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, spans array<bigint>, kept, kept_sha256) of every row.

    ``spans`` has first and last of each maximal run of repeated bytes in turn; ``kept`` are the other bytes, if ``with_text``.
    """
    second = cut(_second(pick(docs, "doc_id", "text"), marked(docs), with_text), "texts")
    contexts = second.where(F.col("row") == CONTEXT)
    spans = _edge_spans(contexts).unionByName(_busy_spans(contexts)).groupBy(*KEYS).agg(F.collect_set(F.struct("first", "last")).alias("more"))
    waiting = second.where(F.col("row") == OPEN).select("doc_id", *KEYS, "body", "spans").join(spans, [*KEYS], "left")
    more = F.coalesce(F.flatten(F.transform("more", lambda s: F.array(s["first"], s["last"]))), F.array().cast("array<bigint>"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in filter(len, parts):
            merged = [[x for s in _merged(list(zip(v[::2], v[1::2], strict=True))) for x in s] for v in map(np.ndarray.tolist, pdf.spans)]
            n, kept, digests = zip(*[_without(b, s, with_text) for b, s in zip(pdf.body, merged, strict=True)], strict=True)
            yield pd.DataFrame({"doc_id": pdf.doc_id, "n_bytes": n, "spans": merged, "kept": list(kept), "kept_sha256": digests})

    done = waiting.select("doc_id", "body", F.concat("spans", more).alias("spans")).mapInPandas(run, "doc_id bigint, n_bytes bigint, spans array<bigint>, kept binary, kept_sha256 string")
    return second.where(F.col("row") == DECIDED).select(*DONE).unionByName(done)


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated passages, as sizes and a digest."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("sign")), lambda s, x: F.struct((s["n"] + s["sign"] * x).alias("n"), (-s["sign"]).alias("sign")), lambda s: s["n"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.floor(F.size("spans") / 2).alias("n_spans"), "kept_sha256")
