"""Line dedup by log templates: lines whose template recurs across documents are dropped.

A line's path in the fixed-depth tree is its token count and its first two tokens; tokens that
hold a digit are variable fields from the start, in lines that are constant enough: half of all
tokens and one of the first two, or three quarters of all. Other lines (rows of numbers) have one
template, all their tokens as they stand. A leaf holds the templates of the rest: as it
stands and, for lines of GENERAL tokens or more, with one of four equal parts of the rest taken
as a variable field, if the line is still constant enough without it. Two lines of a leaf that
differ within one part only thus share a template, whatever the order they come in, and no leaf
ever has to be gathered in one place: templates are 64-bit keys that are counted. A template found in MIN_DOCS documents or more recurs; it stays in
the document with the smallest id and its lines are dropped elsewhere.

Pass 1 counts keys (partial counts in each task first). Pass 2 tests each document's keys
against a bounded filter of the recurring ones; only possible hits shuffle, and only documents
that lose a line shuffle their text. All others pass straight through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import hot_join, keep, key_filter, mix64, released

MIN_DOCS, MIN_TOKENS, LEADING, GENERAL, PARTS = 3, 3, 2, 8, 4
_FIELD = np.uint64(0x5A17F1E1D0000001)
_AS_IS = np.uint64(0x5A17F1E1D0000002)
_NO_ID = (1 << 63) - 1
_FLUSH = 2_000_000
#: Bytes of text that a task reads at a time: its arrays of a number a byte take many times that.
BLOCK_BYTES = 2 << 20


def _constant(constant: np.ndarray, leading: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a template of ``n`` tokens has enough constant ones, ``leading`` of them on its path."""
    return np.where(leading > 0, 2 * constant >= n, 4 * constant >= 3 * n)


def template_keys(column: pa.Array, min_tokens: int = MIN_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, line number and key of every template of every line of ``min_tokens`` tokens or more."""
    words = W.split(column)
    data, at = W.utf8(column)
    lo, hi = int(at[0]), int(at[-1])
    none = np.zeros(0, np.int64)
    if not len(words.hash):
        return none, none, none.astype(np.uint64)
    b = data[lo:hi]
    breaks = np.concatenate([[0], np.cumsum(b == 10)])
    digits = np.concatenate([[0], np.cumsum((b >= 48) & (b <= 57))])
    field = digits[words.end - lo] > digits[words.start - lo]
    line = breaks[words.start - lo]  # counted through the block; rows part lines too
    first = np.flatnonzero(np.diff(line, prepend=-1).astype(bool) | np.diff(words.row, prepend=-1).astype(bool))
    n = np.diff(first, append=len(field))
    place = np.arange(len(field)) - np.repeat(first, n)
    fields = np.concatenate([[0], np.cumsum(field)])
    paths = first + np.minimum(n, LEADING)
    constant, leading = n - (fields[first + n] - fields[first]), paths - first - (fields[paths] - fields[first])
    masked = _constant(constant, leading, n)
    h = np.where(field & np.repeat(masked, n), _FIELD, words.hash)
    use = n >= min_tokens
    first, n, constant, leading, masked = first[use], n[use], constant[use], leading[use], masked[use]
    row, number = words.row[first], line[first] - breaks[at[words.row[first]] - lo]
    leaf = mix64(n.astype(np.uint64) + np.where(masked, np.uint64(1), _AS_IS))
    for k in range(LEADING):
        leaf = mix64(leaf * np.uint64(3) + np.where(n > k, h[np.minimum(first + k, len(h) - 1)], np.uint64(0)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))])
    begin = np.minimum(first + LEADING, first + n)
    rest = total[first + n] - total[begin]
    rows, numbers, keys = [row], [number], [mix64(leaf ^ rest)]
    m = n - LEADING
    for j in range(PARTS):
        a, z = begin + j * m // PARTS, begin + (j + 1) * m // PARTS
        wide = (n >= GENERAL) & masked & _constant(constant - (z - a - (fields[z] - fields[a])), leading, n)
        a, z = a[wide], z[wide]
        part = mix64(np.full(1, j + 1, np.uint64))
        rows.append(row[wide])
        numbers.append(number[wide])
        keys.append(mix64(leaf[wide] ^ (rest[wide] - (total[z] - total[a]) + part)))
    return np.concatenate(rows), np.concatenate(numbers), np.concatenate(keys)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: key, number of documents, smallest id."""
    keys, ids, counts, held = [], [], [], 0

    def fold():
        k, i, c = np.concatenate(keys), np.concatenate(ids), np.concatenate(counts)
        order = np.lexsort((i, k))
        k, i, c = k[order], i[order], c[order]
        at = np.flatnonzero(np.diff(k, prepend=~k[:1]).astype(bool))
        return k[at], i[at], np.add.reduceat(c, at)

    def rows():
        k, i, c = fold()
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c), pa.array(i)], names=["key", "n", "first"])

    for batch in batches:
        for block in W.blocks(batch, size=BLOCK_BYTES):
            row, _, key = template_keys(block.column("text"))
            if not len(key):
                continue
            order = np.lexsort((row, key))
            row, key = row[order], key[order]
            new = np.diff(key, prepend=~key[:1]).astype(bool) | np.diff(row, prepend=-1).astype(bool)
            keys.append(key[new])
            ids.append(block.column("id").to_numpy(zero_copy_only=False)[row[new]])
            counts.append(np.ones(int(new.sum()), np.int64))
            held += len(keys[-1])
            if held > _FLUSH:
                yield rows()
                keys, ids, counts, held = [], [], [], 0
    if keys:
        yield rows()


def _hits(recurring):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch, size=BLOCK_BYTES):
                row, line, key = template_keys(block.column("text"))
                hit = recurring.value.hit(key.view(np.int64))
                if hit.any():
                    yield pa.RecordBatch.from_arrays([pa.array(block.column(c).to_numpy(zero_copy_only=False)[row[hit]]) for c in ("id", "row_key")]
                                                     + [pa.array(line[hit].astype(np.int32)), pa.array(key[hit].view(np.int64))],
                                                     names=["id", "row_key", "line", "key"])

    return run


def _without(schema_names, text_col):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, gone in zip(batch.column(text_col), batch.column("_gone")):
                drop = set(gone.as_py() or ())
                texts.append("\n".join(x for i, x in enumerate((text.as_py() or "").split("\n")) if i not in drop) if drop else text.as_py())
            cols = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in schema_names]
            yield pa.RecordBatch.from_arrays(cols, names=schema_names)

    return run


def drop_recurring_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with recurring lines taken out of the text, and n_dropped (int), the lines that went.

    Every row stays, a text that lost all its lines becomes empty. Null texts stay null and have no
    lines; lines of fewer than MIN_TOKENS tokens never go. Each row counts as a document, rows that
    share an id too; rows with the smallest id (a null id comes last) all keep the template, so
    repeated rows keep theirs alike. Other columns pass through; one named n_dropped is replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_dropped")
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = docs.select(ident.alias("id"), key.alias("row_key"), F.col(text_col).alias("text"))
    counts = rows.select("id", "text").mapInArrow(released(_count), "key long, n long, first long").groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    recurring = keep(counts.where(F.col("n") >= min_docs), "templates")
    size = recurring.agg(F.count("*").alias("n"), F.sum("n").alias("lines")).first()
    hits = rows.mapInArrow(released(_hits(spark.sparkContext.broadcast(key_filter(recurring, "key", size.n)))), "id long, row_key long, line int, key long")
    found = hot_join(keep(hits, "line-hits"), recurring, "key", "n", size.lines or 0)
    gone = keep(found.where("first <> id").groupBy("id", "row_key").agg(F.collect_set("line").alias("_gone")), "lines-gone")
    changed = spark.sparkContext.broadcast(key_filter(gone, "row_key", gone.count()))
    tagged = docs.withColumns({"_id": ident, "_key": key})

    def touched(want):
        def run(batches):
            for batch in batches:
                hit = changed.value.hit(batch.column("_key").to_numpy(zero_copy_only=False)) if len(batch) else np.zeros(0, bool)
                yield batch.filter(pa.array(hit == want))

        return run

    none = F.lit(None).cast("array<int>")
    through = tagged.mapInArrow(touched(False), tagged.schema).select(*docs.columns, F.lit(0).alias("n_dropped"))
    lost = (tagged.mapInArrow(touched(True), tagged.schema).join(gone.select(F.col("id").alias("_id"), F.col("row_key").alias("_key"), "_gone"), ["_id", "_key"], "left")
            .select(*docs.columns, F.coalesce(F.size(F.coalesce("_gone", F.array().cast("array<int>"))), F.lit(0)).alias("n_dropped"), F.coalesce("_gone", none).alias("_gone")))
    names = [*docs.columns, "n_dropped"]
    return through.unionByName(lost.mapInArrow(_without(names, text_col), through.schema))
