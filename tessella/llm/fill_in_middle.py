"""Fill-in-middle transformation by DuckDB inside ``mapInArrow``.

Each Arrow batch is registered with an in-process database, one SQL statement transforms all of its rows, and the result goes back
as Arrow; no row is touched in Python. A text is cut into tokens (runs of letters A-Z, and every other character alone); two of four
numbers taken from a hash of seed and doc_id say where prefix and middle end, the other two whether the text stays as it is
(``plain``) and in which order the parts stand (``psm`` or ``spm``). The parts are marked by ``<P>``, ``<S>`` and ``<M>``, so a text that
holds such a mark stays plain, and the text can be rebuilt from output and form alone; the statement does so from the output.

Memory: a batch is worked on in slices of about ``TOGETHER`` bytes, so a worker holds the tokens of so much text, or of its longest
text. Rows: a null text is empty; an empty text is plain; a null doc_id counts as no digits; texts of any length are cut as a
whole; repeated rows give equal rows; columns beside doc_id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import table

SEED = 1
#: Per cent of texts that stay plain, and of the others that take the order suffix, prefix, middle.
PLAIN, SPM = 10, 20
#: Bytes of text that one statement works on.
TOGETHER = 2_000_000

TRANSFORM = """
WITH cut AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS tokens, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM batch
),
drawn AS (
  SELECT doc_id, text, tokens, len(tokens) AS n,
    ('0x' || h[1:8])::BIGINT % (len(tokens) + 1) AS one, ('0x' || h[9:16])::BIGINT % (len(tokens) + 1) AS two,
    ('0x' || h[17:24])::BIGINT % 100 AS stays, ('0x' || h[25:32])::BIGINT % 100 AS turned
  FROM cut
),
parts AS (
  SELECT doc_id, text, n,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR stays >= {psm_or_spm} THEN 'plain'
      WHEN turned < {spm} THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(list_slice(tokens, 1, least(one, two)), '') AS prefix,
    array_to_string(list_slice(tokens, least(one, two) + 1, greatest(one, two)), '') AS middle,
    array_to_string(list_slice(tokens, greatest(one, two) + 1, n), '') AS suffix
  FROM drawn
),
made AS (
  SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END AS output
  FROM parts
),
rebuilt AS (
  SELECT *,
    CASE form
      WHEN 'psm' THEN split_part(output[4:], '<S>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
      WHEN 'spm' THEN split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(output[4:], '<P>', 1)
      ELSE output END AS restored
  FROM made
)
SELECT doc_id, n::BIGINT AS n, form, prefix_chars::BIGINT AS prefix_chars, middle_chars::BIGINT AS middle_chars, {columns} FROM rebuilt
"""
TEXTS = {"output": "output", "restored": "restored"}
DIGESTS = {"output_sha256": "sha256(output)", "restored_sha256": "sha256(restored)"}


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``TOGETHER`` bytes of text, one row at least."""
    if not batch.num_rows:
        return
    part = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // TOGETHER
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), batch.num_rows], strict=True):
        yield batch.slice(a, b - a)


def transform(docs: DataFrame, seed: int = SEED, plain: int = PLAIN, spm: int = SPM, digests: bool = False) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, restored) of every row; with ``digests`` the two texts give way to their sha256."""
    made = DIGESTS if digests else TEXTS
    query = TRANSFORM.format(seed=int(seed), psm_or_spm=100 - int(plain), spm=int(spm), columns=", ".join(f"{sql} AS {name}" for name, sql in made.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with duckdb.connect(config={"threads": 1}) as con:
            for batch in batches:
                for part in _slices(batch):
                    con.register("batch", pa.Table.from_batches([part]))
                    found = con.sql(query).to_arrow_table()
                    con.unregister("batch")
                    yield from found.cast(schema).to_batches()

    fields = [("doc_id", "bigint"), ("n", "bigint"), ("form", "string"), ("prefix_chars", "bigint"), ("middle_chars", "bigint"), *[(name, "string") for name in made]]
    schema = pa.schema([(name, pa.int64() if kind == "bigint" else pa.string()) for name, kind in fields])
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in fields))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, sizes and digests of every document's transformed and rebuilt text."""
    return transform(table(spark, sf_dir, "documents"), digests=True)


#: Places instead of lists: the parts are substrings of the text at the summed lengths of its tokens, and what is rebuilt is the text.
SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
),
t AS (
  SELECT doc_id, text, list_transform(regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]'), lambda x: length(x)) AS sizes,
    [('0x' || substr(h, 8 * i + 1, 8))::BIGINT for i in range(4)] AS d
  FROM h
),
p AS (
  SELECT doc_id, text, len(sizes) AS n, d,
    coalesce(list_sum(sizes[:least(d[1] % (len(sizes) + 1), d[2] % (len(sizes) + 1))]), 0)::BIGINT AS a,
    coalesce(list_sum(sizes[:greatest(d[1] % (len(sizes) + 1), d[2] % (len(sizes) + 1))]), 0)::BIGINT AS b,
    text = '' OR regexp_matches(text, '<[PSM]>') OR d[3] % 100 >= 90 AS plain
  FROM t
)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN d[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN a END AS prefix_chars, CASE WHEN NOT plain THEN b - a END AS middle_chars,
  sha256(CASE WHEN plain THEN text
    WHEN d[4] % 100 < 20 THEN concat('<S>', substr(text, b + 1), '<P>', substr(text, 1, a), '<M>', substr(text, a + 1, b - a))
    ELSE concat('<P>', substr(text, 1, a), '<S>', substr(text, b + 1), '<M>', substr(text, a + 1, b - a)) END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""
