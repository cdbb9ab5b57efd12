"""Benchmark decontamination by template canonicalisation.

A text becomes a row of tokens: white-space chunks in lower case without marks at their ends; numbers, amounts (a number and its
unit, in one chunk or two) and names (a capitalised word, or several with no mark between) become the typed placeholders
``<num>``, ``<num><unit>`` and ``<name>``. Whether a capitalised word at a sentence start is a name can't be told, so a text has
two readings: one takes such words as plain, the other as names; each is compared with the same reading of an item. A document leaks
an item if it holds at least ``SHARE`` of the item's distinct windows of ``WIDTH`` tokens and the slots are consistent: each number,
unit and name that the item's placeholders have stands for one of the document over the matched windows, and different ones for
different ones. So a question whose numbers or names were changed throughout is found, and a coincidence of templates with
contradictory slots is not.

1. The items' windows are a table. A bit table of ``BITS`` bits with two bits a window, of one size for any benchmark, is broadcast;
   documents are read once and give their windows that pass it, with the values in their slots, one row a document and reading.
2. A document that holds ``SHARE`` of an item's windows holds one of any choice of more than the rest of them. So the windows of
   documents are hash-joined, by window, with the rarest ones of every item, as many as that takes; this loses no pair.
3. Each pair of document and item meets with the document's windows that are the item's, and the slots are compared.

Rows: null and empty texts match nothing, as items and as documents; an item of fewer than ``WIDTH`` tokens has one window of its
own length; items of equal id and text count once; an item without an id is listed as null; a repeated document row is judged alike,
rows of one doc_id (or none) and other texts each for itself; with an empty benchmark no document leaks; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import KEYS, cut, keyed, pick, table
from tessella.llm.words import KEPT, Memo, batches, hold, mix, number, windows

WIDTH, SHARE = 5, 0.8
#: Bits of the table in front of the windows, as a power of two (8 MB), and tasks over which a window's documents are dealt.
BITS, SALTS = 26, 8
#: Offsets from which a chain of several is tried.
CHAINS = 16
#: Units that follow a number.
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs ms d day days week weeks month months year years second seconds minute minutes hour hours inch inches foot feet mile miles meter meters metre metres gram grams kilogram kilograms liter liters litre litres pound pounds ounce ounces dollar dollars euro euros cent cents usd eur gbp percent kmh mph w kw kwh v a hz khz mhz ghz kb mb gb tb".split())
AMOUNT = re.compile(r"[$€£+-]*\d+(?:[.,:/-]\d+)*-?([^\W\d_]*|%)$")
ENDS = frozenset(".!?:;")
NUM, NAME, BOTH = (np.uint64(number(x)) for x in ("<num>", "<name>", "<num><unit>"))

PLAIN, SLOT, MAYBE_UNIT, MAYBE_NAME = 0, 1, 2, 3


#: Marks of a chunk: it ends a sentence, has a mark at its end, has one at its start.
ENDING, CLOSED, OPENED = 1, 2, 4


def _chunk(chunk: str) -> tuple[int, int, int, tuple[tuple[str, str], ...]]:
    """(number, kind, marks, typed values) of a chunk; the number is 0 if nothing but marks is left."""
    if chunk.isalnum():
        core, marks = chunk, 0
    else:
        i, j = 0, len(chunk)
        while j and not chunk[j - 1].isalnum():
            j -= 1
        while i < j and not chunk[i].isalnum():
            i += 1
        core = chunk[i:j]
        marks = ENDING * (not ENDS.isdisjoint(chunk[j:])) + CLOSED * (j < len(chunk)) + OPENED * (i > 0 or not core)
    if not core:
        return (0, MAYBE_UNIT, marks & ~OPENED, (("unit", "%"),)) if chunk.rstrip(".,;:!?") == "%" else (0, PLAIN, marks, ())
    low = core.lower()
    found = AMOUNT.match(low) if core[0].isdecimal() else None
    if found and (not found[1] or found[1] in UNITS or found[1] == "%"):
        unit = found[1] or ("%" if chunk.rstrip(".,;:!?").endswith("%") else "")
        return int(BOTH if unit else NUM), SLOT, marks, (("num", low[: found.start(1)].rstrip("-")), *[("unit", unit)] * bool(unit))
    if low in UNITS:
        return number(low), MAYBE_UNIT, marks, (("unit", low),)
    if core[0].isupper() and all(part[:1].isupper() and part[1:].islower() for part in core.split("-")):
        return number(low), MAYBE_NAME, marks, (("name", low),)
    return number(low), PLAIN, marks, ()


_chunks = Memo(_chunk)


def _read(h: np.ndarray, kind: np.ndarray, marks: np.ndarray, first: np.ndarray, starts: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, slots, which chunks begin a token and which belong to the token before; ``starts``: sentence starts may be names."""
    last = lambda x: np.append(False, x[:-1])
    tied = ~first & ~last(marks & CLOSED > 0) & (marks & OPENED == 0)
    name = kind == MAYBE_NAME
    if not starts:
        name &= ~(first | last(marks & ENDING > 0))
    unit = (kind == MAYBE_UNIT) & last(h == NUM) & tied
    more = unit | (name & last(name) & tied)
    h = np.where(name, NAME, np.where(np.append(unit[1:], False), BOTH, h))
    return h, (kind == SLOT) | name, (h != 0) & ~more, more


def canonical(text: str, starts: bool = False) -> tuple[np.ndarray, np.ndarray, list[tuple[tuple[str, str], ...]]]:
    """Numbers of a text's tokens, which of them are slots, and the slots' typed values."""
    found = [_chunks[c] for c in text.split()]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, bool), []
    h, kind, marks, values = zip(*found, strict=True)
    h, kind, marks = np.array(h, np.uint64), np.array(kind, np.int8), np.array(marks, np.int8)
    h, slot, keep, more = _read(h, kind, marks, np.arange(len(h)) == 0, starts)
    out: list[tuple[tuple[str, str], ...]] = []
    for value, kept, joins in zip(values, keep.tolist(), more.tolist(), strict=True):
        if kept:
            out.append(value)
        elif joins:
            out[-1] = (("name", f"{out[-1][0][1]} {value[0][1]}"),) if value[0][0] == "name" else out[-1] + value
    return h[keep], slot[keep], out


class Learned:
    """Numbers and kinds of the chunks met so far, in arrays by place; started anew before a batch when there are more than ``KEPT``."""

    def __init__(self) -> None:
        self.places: dict[str, int] = {}
        self.tables: list[np.ndarray] = []

    def look_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number, kind, marks and text of every chunk of the texts, in a row."""
        if len(self.places) > KEPT:
            self.__init__()
        cut = [t.split() for t in texts]
        places = self.places
        new = [c for c in {c for chunks in cut for c in chunks} if c not in places]
        if new or not self.tables:
            found = [(h, kind, marks) for h, kind, marks, _ in map(_chunk, new)] or [(0, PLAIN, 0)]
            columns = [np.array(x, t) for x, t in zip(zip(*found, strict=True), (np.uint64, np.int8, np.int8), strict=True)]
            if not new:
                columns = [c[:0] for c in columns]
            self.tables = [np.concatenate([a, b]) for a, b in zip(self.tables, columns, strict=True)] if self.tables else columns
            places.update(zip(new, range(len(places), len(places) + len(new)), strict=True))
        n = [len(c) for c in cut]
        flat = np.fromiter((places[c] for chunks in cut for c in chunks), np.int64, sum(n))
        return *(t[flat] for t in self.tables), np.repeat(np.arange(len(texts)), n)


def tokens(texts: list[str], learned: Learned) -> list[tuple[np.ndarray, np.ndarray]]:
    """For both readings, numbers of the tokens of all texts in a row, as ``canonical`` makes them, and which text each belongs to."""
    h, kind, marks, text = learned.look_up(texts)
    if not len(h):
        return [(h, text)] * 2
    first = np.append(True, text[1:] != text[:-1])
    out = []
    for starts in (False, True):
        read, _, keep, _ = _read(h, kind, marks, first, starts)
        out.append((read[keep], text[keep]))
    return out


def _bits(h: np.ndarray) -> list[np.ndarray]:
    """The two places of each window in the bit table."""
    shift = np.uint64(64 - BITS)
    return [(x >> shift).astype(np.int64) for x in (h, mix(h ^ np.uint64(0x5851F42D4C957F2D)))]


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, text, reading, width, own): the distinct windows of every item in both readings; ``item`` is a hash of id and text."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for item, item_id, text in zip(pdf.item, pdf.item_id, pdf.text, strict=True):
                for starts in (False, True):
                    h, _, _ = canonical(text, starts)
                    width = min(WIDTH, len(h))
                    if width:
                        out.append((item, None if pd.isna(item_id) else int(item_id), text, starts, width, np.unique(windows(h, width)).view(np.int64)))
            _chunks.clear()
            yield pd.DataFrame(out, columns=["item", "item_id", "text", "reading", "width", "own"]).astype({"item_id": "Int64"})

    items = benchmark.where("text IS NOT NULL").select(F.xxhash64(F.col("item_id").isNull(), "item_id", "text").alias("item"), F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    return items.mapInPandas(run, "item bigint, item_id bigint, text string, reading boolean, width int, own array<bigint>")


def bit_table(own: DataFrame) -> np.ndarray:
    """The bit table of the windows in column ``w``, as bytes; the driver takes 2 ** (BITS - 6) numbers at most."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            places = np.concatenate(_bits(pdf.w.to_numpy(np.int64).view(np.uint64)))
            yield pd.DataFrame({"place": places >> 6, "bit": np.left_shift(np.uint64(1), (places & 63).astype(np.uint64)).view(np.int64)})

    rows = own.mapInPandas(run, "place bigint, bit bigint").groupBy("place").agg(F.bit_or("bit").alias("bits")).toPandas()
    table_ = np.zeros(1 << (BITS - 6), np.int64)
    table_[rows.place.to_numpy(np.int64)] = rows.bits.to_numpy(np.int64)
    return table_.view(np.uint8)


HITS = "array<struct<w:bigint,at:int,slots:string>>"


def hits(docs: DataFrame, bits: np.ndarray, widths: list[int]) -> DataFrame:
    """(row_k1, row_k2, reading, hits) of the documents that have windows in the bit table: window, place and the values of its slots."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("templates", _chunks.clear)
        learned, table_ = Learned(), shared.value
        has = lambda places: (table_[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0
        for pdf in parts:
            for some in batches(pdf):
                texts, keys = some["_text"].tolist(), some[[*KEYS]].to_numpy(np.int64)
                out = []
                for starts, (h, text) in zip((False, True), tokens(texts, learned), strict=True):
                    first = np.searchsorted(text, np.arange(len(texts)))
                    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
                    for width in widths:
                        own = windows(h, width)
                        maybe = np.flatnonzero(has((own >> np.uint64(64 - BITS)).astype(np.int64)) & (text[: len(own)] == text[width - 1 :]))
                        maybe = maybe[has(_bits(own[maybe])[1])]
                        for place, of in zip(maybe.tolist(), text[maybe].tolist(), strict=True):
                            found[of].append((int(own[place].view(np.int64)), place - int(first[of]), width))
                    for of, windows_ in found.items():
                        _, slot, values = canonical(texts[of], starts)
                        slots = [_written([(d, values[at + d]) for d in range(width) if slot[at + d]]) for _, at, width in windows_]
                        out.append((*keys[of], starts, [{"w": w, "at": at, "slots": s} for (w, at, _), s in zip(windows_, slots, strict=True)]))
                yield pd.DataFrame(out, columns=[*KEYS, "reading", "hits"])
        _chunks.clear()

    rows = keyed(docs).select(*KEYS, F.coalesce("text", F.lit("")).alias("_text"))
    return rows.mapInPandas(run, f"{KEYS[0]} bigint, {KEYS[1]} bigint, reading boolean, hits {HITS}")


def _written(slots: list[tuple[int, tuple[tuple[str, str], ...]]]) -> str:
    """Places and typed values of a window's slots, in one string; a chunk has no control characters that are white space."""
    return "\n".join("\t".join([str(d), *[x for kind, value in values for x in (kind, value)]]) for d, values in slots)


def _read_back(slots: str) -> Iterator[tuple[int, tuple[tuple[str, str], ...]]]:
    for line in filter(None, slots.split("\n")):
        d, *rest = line.split("\t")
        yield int(d), tuple(zip(rest[::2], rest[1::2], strict=True))


Pairs = frozenset[tuple[tuple[str, str], tuple[str, str]]]


def _one_to_one(pairs: Pairs) -> bool:
    return len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})


def _consistent(pairs: list[tuple[int, int]], own: list[int], width: int, item_slot: np.ndarray, item_values: list, slot: dict, values: dict) -> bool:
    """Some copy of the item in the document holds ``SHARE`` of the item's distinct windows ``own`` and maps slot values one to one.

    Windows are grouped by their offset against the item; a copy without insertions has one offset, and each that alone has
    enough windows is judged for itself, so that other copies don't contradict it. A copy with insertions or gaps is a chain of
    offsets: from each of the ``CHAINS`` largest consistent ones, others are added, larger ones first, where they bring windows
    and don't contradict what is there.
    """
    need = SHARE * len(set(own))
    by: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for place, there in pairs:
        by[place - there].append((place, there))
    segments: dict[tuple[frozenset[int], Pairs], None] = {}  # copies with the same values count once
    for run in by.values():
        found = {(there, place) for place, there in run}
        slots = {(there + d, place + d) for there, place in found for d in range(width) if item_slot[there + d] and place + d in slot}
        mapped = frozenset(pair for i, j in slots for pair in zip(item_values[i], values[j], strict=True))
        if _one_to_one(mapped):
            held = frozenset(own[there] for there, _ in found)
            if len(held) >= need:
                return True
            segments[held, mapped] = None
    order = sorted(segments, key=lambda x: -len(x[0]))
    if not order or len(frozenset().union(*(held for held, _ in order))) < need:
        return False
    for held, mapped in order[:CHAINS]:
        for more, also in order:
            if not more <= held and _one_to_one(mapped | also):
                held, mapped = held | more, mapped | also
                if len(held) >= need:
                    return True
    return False


def _leaks(text: str, starts: bool, found: list) -> tuple[float, bool]:
    """Share of the item's windows that a document's windows (w, at, slots) make up, and whether some copy is consistent."""
    h, item_slot, item_values = canonical(text, starts)
    width = min(WIDTH, len(h))
    own = windows(h, width).view(np.int64).tolist()
    share = len({x["w"] for x in found}) / len(set(own))
    if share < SHARE:
        return share, False
    there: dict[int, list[int]] = defaultdict(list)
    for place, w in enumerate(own):
        there[w].append(place)
    values = {x["at"] + d: v for x in found for d, v in _read_back(x["slots"])}
    pairs = [(x["at"], t) for x in found for t in there[x["w"]]]
    return share, _consistent(pairs, own, width, item_slot, item_values, values, values)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row_k1, row_k2, items array<struct<item_id, share, consistent>>) of every document that has enough windows of an item."""
    items = cut(item_windows(pick(benchmark, "item_id", "text")), "items")
    own = items.select("item", "reading", F.explode("own").alias("w"))
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # from 1 to WIDTH
    found = cut(hits(pick(docs, "doc_id", "text"), bit_table(own.select("w").distinct()), widths), "hits")
    common = own.groupBy("reading", "w").agg(F.count("*").alias("n"))
    order = Window.partitionBy("item", "reading").orderBy("n", "w")
    enough = F.size("own") - F.ceil(F.lit(SHARE) * F.size("own") - 1e-9) + 1  # all but these are too few
    rare = own.join(common, ["reading", "w"]).withColumn("at", F.row_number().over(order))
    rare = rare.join(items.select("item", "reading", enough.alias("enough")), ["item", "reading"]).where("at <= enough")
    rare = rare.select("item", "reading", "w", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    held = found.select(*KEYS, "reading", F.explode(F.array_distinct(F.transform("hits", lambda x: x["w"]))).alias("w"), F.pmod(KEYS[0], F.lit(SALTS)).cast("int").alias("salt"))
    pairs = held.join(rare, ["reading", "w", "salt"]).select(*KEYS, "reading", "item").distinct()
    met = pairs.join(items.select("item", "reading", "item_id", "text", "own"), ["item", "reading"]).join(found.dropDuplicates([*KEYS, "reading"]), [*KEYS, "reading"])
    met = met.select(*KEYS, "reading", "item_id", "text", F.filter("hits", lambda x: F.array_contains("own", x["w"])).alias("hits"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = [_leaks(t, bool(s), h) for t, s, h in zip(pdf.text, pdf.reading, pdf.hits, strict=True)]
            yield pdf[[*KEYS]].assign(item_id=pdf.item_id.astype("Int64"), share=[x for x, _ in out], consistent=[x for _, x in out])
        _chunks.clear()

    judged = met.mapInPandas(run, f"{KEYS[0]} bigint, {KEYS[1]} bigint, item_id bigint, share double, consistent boolean").where(F.col("share") >= SHARE)
    best = judged.groupBy(*KEYS, "item_id").agg(F.max(F.struct("consistent", "share")).alias("best"))
    return best.groupBy(*KEYS).agg(F.array_sort(F.collect_set(F.struct("item_id", "best.share", "best.consistent"))).alias("items"))


def leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(row_k1, row_k2, leaked_items): the documents that leak items, and which."""
    ids = F.transform(F.filter("items", lambda x: x["consistent"]), lambda x: x["item_id"])
    return matches(docs, benchmark).select(*KEYS, F.array_sort(ids).alias("leaked_items")).where(F.size("leaked_items") > 0)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, leaked, n_items, items) of every document: whether it leaks items, which, and how many."""
    found = cut(leaking(docs, benchmark), "leaks")
    rows = keyed(pick(docs, "doc_id", "text")).select(F.col("doc_id").cast("bigint").alias("doc_id"), *KEYS).join(found, [*KEYS], "left")
    items = F.coalesce("leaked_items", F.array().cast("array<bigint>"))
    return rows.select("doc_id", F.col("leaked_items").isNotNull().alias("leaked"), F.size(items).alias("n_items"), items.alias("items"))


def op10_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document leaks."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
