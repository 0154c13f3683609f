from __future__ import annotations

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as P
from contrail.llm import op2_mix
from contrail.llm import words as W
from contrail.llm.common import BATCH_BYTES, keep, small_batches, without_ids
from contrail.llm.queries import vocabulary
from tests.llm import test_op5, test_op7
from tests.llm.helpers import odd_docs

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], key=str)


def test_each_stage_on_its_predecessor(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    clean = keep(P.toxicity(spark, docs, SF), "t1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    gone = {r.doc_id for r in docs.collect()} - kept
    assert clean.columns == columns and sum(labels.get(i) == 0 for i in gone) <= 1

    lines = keep(P.line_dedup(spark, clean, SF), "t2")
    assert lines.columns == columns and rows(lines) == sorted([(i, t) for i, t, _ in test_op5.brute(rows(clean))], key=str)
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    single = keep(P.near_duplicates(spark, lines, SF), "t3")
    stay = {i for i, _, c in test_op7.brute(rows(lines)) if i == c}
    assert single.columns == columns and {i for i, _ in rows(single)} == stay

    mixed = keep(P.mixing(spark, single, SF), "t4")
    fate = {r.doc_id: r._kept for r in op2_mix.mix(single).collect()}
    assert mixed.columns == columns and {i for i, _ in rows(mixed)} == {i for i, k in fate.items() if k}

    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary().ranks, special_tokens={})
    texts = dict(rows(mixed))
    got = P.byte_bpe(spark, mixed, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == ref.encode_ordinary(t) and r.n_tokens * 4 == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_without_ids(spark):
    docs = odd_docs(spark)
    got = without_ids(docs, "doc_id", spark.createDataFrame([(5,), (6,), (77,), (None,)], "doc_id long"), "t")
    assert got.columns == docs.columns and rows(got) == [x for x in rows(docs) if x[0] not in (5, 6)]
    assert without_ids(docs, "doc_id", docs.where(F.lit(False)).select("doc_id"), "t").count() == docs.count()


def near_brute(rows, words, percent):
    """Ids that stay: the smallest of each group linked by ``percent`` of shared shingles of ``words`` words."""
    sets = [test_op7.shingles(t, words) for _, t in rows]
    group = {i: i for i, _ in rows}
    for a, (i, _) in enumerate(rows):
        for b, (j, _) in enumerate(rows[:a]):
            if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    return {i for i, g in group.items() if i == g}


def test_near_duplicates_at_five_words_and_four_fifths(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    extra = []
    for g in range(6):
        text = [f"w{g}x{k}" for k in range(46 + 4 * g)]
        other = [*text[:20], "changed", *text[21:]]
        extra += [(10_000 + 2 * g, " ".join(text)), (10_001 + 2 * g, " ".join(other))]
    docs = keep(docs.unionByName(spark.createDataFrame(extra, docs.schema)), "t")
    stay = near_brute(rows(docs), 5, 80)
    assert {i for i, _ in rows(P.near_duplicates(spark, docs, SF))} == stay
    assert stay < near_brute(rows(docs), 4, 85)  # pairs between the two limits


def test_arrow_batches_of_text_are_bounded(spark):
    small_batches(spark)
    docs = spark.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("word "), 400).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

    got = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 6000
    assert max(r.size for r in got) <= BATCH_BYTES * 1.1


def test_splitting_a_block_takes_little_memory():
    def split(texts):
        words = W.split(pa.array(texts))
        want = [w for t in texts for w in t.encode().split()]
        assert [words.text(i) for i in range(len(words.start))] == want
        ids = {}
        assert all(ids.setdefault(w, h) == h for w, h in zip(want, words.hash.tolist())) and len(set(ids.values())) == len(ids)

    W._powers.cache_clear()
    tracemalloc.start()
    W.split(pa.array(["several words of text " * 20_000] * 2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 << 20
    split(["several words of text " * 20_000, "x" * 700_000 + " end of text"])
