"""Byte-level BPE encoding by recursive DuckDB queries inside each partition, and decoding.

Encoding: texts are cut in front of every single space between two non-space characters, where no match of the pattern can
reach across; the distinct pieces of a batch are matched once, and the distinct matches (words) that are not known yet go to one
recursive query. Its state is a word's tokens; a step turns them into token-position rows, joins neighbours with the merge table
and contracts each word's leftmost pair of the least rank, until no pair of the word is in the table. The key of the recursion
keeps the last state only, so memory follows the words, not the steps. Decoding takes the bytes of a batch's ids from the vocabulary, an Arrow
array by id; they lie one after the other, so a text's bytes are what lies between the places of its first and its last id.

A word over ``LONG`` bytes is encoded in pieces whose seams are tested; see ``Codec._contract_long``.

What a worker has learned of words and pieces is kept for later batches in two generations of about ``KEPT`` entries (or fewer, where
memory is short); what was not met during a whole generation is dropped, and all of it when another operator uses the worker. Results do not depend on it.
Rows: a null text is empty; an empty text has no ids; texts and words of any length are encoded whole; repeated rows are encoded
alike; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import table
from tessella.llm.words import batches, hold

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words that one recursive query takes, pieces a worker remembers, and bytes from which a word is cut.
WORDS, KEPT, LONG = 40_000, 400_000, 64
#: Bytes of the texts that are worked on together.
TOGETHER = 1_000_000

#: White space beside a space; it begins with one class, so the search runs from one white space to the next.
BESIDE = re.compile(r"\s(?: |(?<= )\s)")

CONTRACT = """
WITH RECURSIVE bpe(word, tokens) USING KEY (word) AS (
  SELECT word, tokens FROM words
  UNION
  SELECT b.word, b.tokens[:spot - 1] || [merged] || b.tokens[spot + 2:]
  FROM (
    SELECT word, min(m.token * 4294967296 + position) AS least, least // 4294967296 AS merged, least % 4294967296 AS spot
    FROM (
      SELECT word, unnest(tokens[:-2]) AS token, unnest(tokens[2:]) AS following, generate_subscripts(tokens[2:], 1) AS position
      FROM bpe WHERE len(tokens) > 1
    ) p
    JOIN merges m ON p.token * 65536 + p.following = m.pair
    GROUP BY word
  ) n JOIN bpe b USING (word)
)
SELECT word, tokens FROM bpe
"""

#: The same for long words: all leftmost pairs of the word's least rank at once.
CONTRACT_ALL = """
WITH RECURSIVE bpe(word, tokens) USING KEY (word) AS (
  SELECT word, tokens FROM words
  UNION
  SELECT word, list(CASE WHEN taken THEN least ELSE token END ORDER BY position)
  FROM (
    SELECT word, position, token, least, taken, lag(taken, 1, false) OVER (PARTITION BY word ORDER BY position) AS gone
    FROM (
      -- of a run of equal pairs, as in aaaa, every other one counts from the left
      SELECT word, position, token, least, hit AND row_number() OVER (PARTITION BY word, hit, island ORDER BY position) % 2 = 1 AS taken
      FROM (
        SELECT word, position, token, least, hit, position - row_number() OVER (PARTITION BY word, hit ORDER BY position) AS island
        FROM (
          SELECT p.word, p.position, p.token, least, coalesce(m.token = least, false) AS hit
          FROM (
            SELECT word, unnest(tokens) AS token, unnest(tokens[2:] || [-1]) AS following, generate_subscripts(tokens, 1) AS position
            FROM bpe WHERE len(tokens) > 1
          ) p
          LEFT JOIN merges m ON p.token * 65536 + p.following = m.pair
          JOIN (
            SELECT word, min(m.token) AS least
            FROM (SELECT word, unnest(tokens[:-2]) AS token, unnest(tokens[2:]) AS following FROM bpe WHERE len(tokens) > 1) q
            JOIN merges m ON q.token * 65536 + q.following = m.pair
            GROUP BY word
          ) l ON p.word = l.word
        )
      )
    )
  )
  WHERE NOT gone
  GROUP BY word
)
SELECT word, tokens FROM bpe
"""

class Codec:
    """The vocabulary of one file, and its merge table in an in-process database with a single thread."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.single = np.array([ranks[bytes([b])] for b in range(256)])
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        # a pair's rank is the id of what it makes. Of the splits of a token only those whose parts rank below it are ever contracted:
        # inside a token's bytes the steps are those of encoding it alone, and their ranks rise (true of every token here; tested)
        splits = ((t[:i], t[i:], r) for t, r in ranks.items() for i in range(1, len(t)))
        merges = [(ranks[a] * 65536 + ranks[b], r) for a, b, r in splits if ranks.get(a, r) < r and ranks.get(b, r) < r]
        pair, made = zip(*merges, strict=True)  # ids are below 65,536
        self.bytes = {r: t for t, r in ranks.items()}
        self.decimal = [f" {i}" for i in range(max(self.bytes) + 1)]
        self.fits: set[tuple[int, int]] = set()
        self.vocabulary = pa.array([self.bytes.get(i) for i in range(max(self.bytes) + 1)], pa.binary())
        self._table("merges", pa.table({"pair": pair, "token": made}))
        self.known: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.kept = KEPT

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("rows", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows")
        self.con.unregister("rows")

    def _query(self, words: list[bytes], query: str) -> list[list[int]]:
        out: list[list[int]] = []
        for start in range(0, len(words), WORDS):
            some = words[start : start + WORDS]
            ends = np.cumsum([0, *map(len, some)], dtype=np.int32)
            tokens = pa.ListArray.from_arrays(ends, self.single[np.frombuffer(b"".join(some), np.uint8)])
            self.con.register("words", pa.table({"word": pa.array(range(len(some)), pa.int64()), "tokens": tokens}))
            by = dict(self.con.execute(query).fetchall())
            self.con.unregister("words")
            out += [by[i] for i in range(len(some))]
        return out

    def contract(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self._query(words, CONTRACT)
        out = self._query([b"" if len(w) > LONG else w for w in words], CONTRACT)
        for i, ids in zip(long, self._contract_long([words[i] for i in long]), strict=True):
            out[i] = ids
        return out

    def _contract_long(self, words: list[bytes]) -> list[list[int]]:
        """The ids of words over ``LONG`` bytes, by pieces.

        A row of tokens is the encoding of its bytes if and only if each pair of neighbours is the encoding of its own bytes: what
        two tokens make in the whole word they would make alone, as no merge ranks below its parts. So pieces are encoded alone, and where the two tokens at a seam aren't their own encoding, the two
        pieces become one and are encoded again.
        """
        cut = [[w[k : k + LONG] for k in range(0, len(w), LONG)] for w in words]
        done: list[list[list[int] | None]] = [[None] * len(c) for c in cut]
        while True:
            new = [(i, k) for i, d in enumerate(done) for k, ids in enumerate(d) if ids is None]
            if not new:
                return [[t for ids in d for t in ids] for d in done]
            pieces = [cut[i][k] for i, k in new]
            ids = self._query([p if len(p) <= 2 * LONG else b"" for p in pieces], CONTRACT)
            for at, found in zip(longer := [k for k, p in enumerate(pieces) if len(p) > 2 * LONG], self._query([pieces[k] for k in longer], CONTRACT_ALL), strict=True):
                ids[at] = found
            for (i, k), found in zip(new, ids, strict=True):
                done[i][k] = found
            seams = [(i, k) for i, d in enumerate(done) for k in range(len(d) - 1) if (d[k][-1], d[k + 1][0]) not in self.fits]
            pairs = list({(done[i][k][-1], done[i][k + 1][0]) for i, k in seams})
            alone = dict(zip(pairs, self._query([self.bytes[a] + self.bytes[b] for a, b in pairs], CONTRACT), strict=True))
            for i in range(len(done)):
                broken = {k for j, k in seams if j == i and alone[done[i][k][-1], done[i][k + 1][0]] != [done[i][k][-1], done[i][k + 1][0]]}
                if broken:
                    parts, ids_of = [cut[i][0]], [done[i][0]]
                    for k in range(1, len(cut[i])):
                        if k - 1 in broken:
                            parts[-1], ids_of[-1] = parts[-1] + cut[i][k], None
                        else:
                            parts.append(cut[i][k])
                            ids_of.append(done[i][k])
                    cut[i], done[i] = parts, ids_of
            if len(self.fits) > KEPT:
                self.fits.clear()
            self.fits |= {p for p in pairs if alone[p] == list(p)}

    def _unknown(self, asked: set[str]) -> list[str]:
        """What isn't known; what the generation before knew is known again."""
        new = []
        for x in asked.difference(self.known):
            ids = self.old.get(x)
            if ids is None:
                new.append(x)
            else:
                self.known[x] = ids
        return new

    def _ids(self, pieces: set[str]) -> dict[str, str]:
        """All that is known, with the ids of each piece and of its words, each id after a space; a piece that is a word is one entry."""
        if len(self.known) > self.kept:
            self.old, self.known = self.known, {}
        new = {p: self.pattern.findall(p) for p in self._unknown(pieces)}
        words = self._unknown({p if len(c) == 1 else w for p, c in new.items() for w in c})
        for w, ids in zip(words, self.contract([w.encode() for w in words]), strict=True):
            self.known[w] = "".join(map(self.decimal.__getitem__, ids))
        for p, c in new.items():
            if len(c) != 1:
                self.known[p] = "".join(map(self.known.__getitem__, c))
        return self.known

    def encode(self, texts: list[str]) -> list[str]:
        """Each text's ids in decimals, joined by single spaces."""
        cut = []
        for text in texts:
            if not text or text[0].isspace() or text[-1].isspace() or BESIDE.search(text):
                cut.append(self.pattern.findall(text))  # white space of several characters: match by match
            elif "\0" in text:
                first, *rest = text.split(" ")
                cut.append([first, *[" " + p for p in rest]])
            else:
                cut.append(text.replace(" ", "\0 ").split("\0"))  # in front of every space
        ids = self._ids(set().union(*cut))
        return ["".join(map(ids.__getitem__, c))[1:] for c in cut]

    def decode(self, ids: list[str]) -> list[bytes]:
        """The bytes of each row of decimal ids."""
        numbers = np.fromstring(" ".join(ids), dtype=np.int64, sep=" ")
        ends = np.cumsum([0, *[x.count(" ") + 1 if x else 0 for x in ids]])
        taken = self.vocabulary.take(pa.array(numbers))
        places, data = np.frombuffer(taken.buffers()[1], np.int32)[ends], taken.buffers()[2]
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(places), data]).to_pylist()


@lru_cache(maxsize=1)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _default(vocabulary: str | None) -> tuple[str, str]:
    import public_tokenizers

    return vocabulary or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _own(path: str, pattern: str, kept: int = KEPT) -> Codec:
    """This worker's codec, which other operators release."""
    hold("byte_bpe", codec.cache_clear)
    own = codec(path, pattern)
    own.kept = kept
    return own


def encode(docs: DataFrame, id_col: str = "doc_id", text: Column | str = "text", vocabulary: str | None = None) -> DataFrame:
    """(id, ids): the ids of every text, in decimals joined by spaces."""
    path, pattern = _default(vocabulary)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for some in batches(pdf):
                yield pd.DataFrame({id_col: some[id_col], "ids": _own(path, pattern).encode(some["_text"].tolist())})

    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).alias("_text"))
    return rows.mapInPandas(run, f"{id_col} bigint, ids string")


def decode(coded: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(id, bytes) of rows (id, ids) as ``encode`` gives them."""
    path, pattern = _default(vocabulary)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for some in batches(pdf, "ids"):
                yield pd.DataFrame({id_col: some[id_col], "bytes": _own(path, pattern).decode(some["ids"].tolist())})

    return coded.select(id_col, F.coalesce("ids", F.lit("")).alias("ids")).mapInPandas(run, f"{id_col} bigint, bytes binary")


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, one row at least; only a slice is ever turned into Python strings."""
    part = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
    for a, b in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows], strict=bool(len(part))):
        yield batch.slice(a, b - a)


def round_trip(docs: DataFrame, id_col: str = "doc_id", vocabulary: str | None = None, with_bytes: bool = True, kept: int = KEPT, together: int = TOGETHER) -> DataFrame:
    """(id, n_tokens, ids, ids_sha256, decoded, decoded_sha256): encoding and then decoding the ids, in one pass over the rows.

    Without ``with_bytes`` the decoded bytes give their digest only, and ``decoded`` is null. ``kept`` and ``together`` trade the memory of a worker
    (pieces remembered, bytes worked on at once) for time.
    """
    path, pattern = _default(vocabulary)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in _slices(part, together):
                own = _own(path, pattern, kept)
                ids = own.encode(some.column("text").to_pylist())
                back = own.decode(ids)
                columns = [
                    some.column("id"), pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64()), pa.array(ids, pa.string()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in ids]),
                    pa.array(back if with_bytes else [None] * len(back), pa.binary()), pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids", "ids_sha256", "decoded", "decoded_sha256"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"{id_col} bigint, n_tokens bigint, ids string, ids_sha256 string, decoded binary, decoded_sha256 string")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    return round_trip(table(spark, sf_dir, "documents"), with_bytes=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
