"""The pipeline's stages and what holds between them."""

import ctypes
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from corpuskit.llm import bpe, language_id, pii, simhash_dedup

from .conftest import prose


def test_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, None).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] > 0.97 * counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    assert counts[4] == counts[3]
    out = corpus_pipeline.STAGES[-1][1](spark, docs, None)
    assert out.where("not round_trip").count() == 0 and out.count() == counts[4]
    text = {(r.doc_id, r.text) for r in docs.collect()}
    assert {tuple(r) for r in bpe.decode(out).collect()} == text


def test_stages_on_messy_and_empty(spark, messy, nothing, tmp_path):
    for k, docs in enumerate((messy, nothing)):
        first, kept = docs, []
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, None).write.parquet(str(tmp_path / f"{name}{k}"))
            docs = spark.read.parquet(str(tmp_path / f"{name}{k}"))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert docs.columns == first.columns
            kept.append(sorted((r.doc_id if r.doc_id is not None else -1) for r in docs.collect()))
        if docs.count() == 0:
            assert kept == [[]] * 5
            continue
        # Texts that are null or have no letter are in no language.
        assert not {6, 7, 8} & set(kept[0])
        # 1, 2 and 3 are near copies, as are 4 and 5; a row without an id stays.
        assert set(kept[1]) <= set(kept[0]) - {2, 3, 5} and (1 in kept[1]) == (1 in kept[0]) and kept[1].count(-1) == kept[0].count(-1)
        assert kept[2] == kept[1] and len(kept[3]) == len(kept[2]) == len(kept[4])
        assert set(kept[3]) <= set(kept[2])


def test_near_duplicates_that_share_no_choice(spark):
    """Near copies that agree in no choice of bits, so that sampling keeps both."""
    texts = []
    for seed in (969, 2255, 2922, 3617, 6037, 6523, 6976, 8144):
        words = prose(seed, 60)
        texts += [" ".join(words), " ".join(words[:-6] + prose(seed + 10**6, 6))]
    fp, _ = simhash_dedup.fingerprint_rows(pa.array(texts, pa.large_string()))
    assert (np.bitwise_count(fp[::2] ^ fp[1::2]).sum(axis=1) <= simhash_dedup.RADIUS).all()
    key = simhash_dedup.Keys(simhash_dedup.choices(len(texts))).of(fp)
    assert not (key[::2] == key[1::2]).any()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, docs, None).collect()) == list(range(0, len(texts), 2))


def _anonymous() -> float:
    """MB of this process's own memory."""
    return int(re.search(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_workers_give_memory_back(spark, monkeypatch):
    """A worker that has done its task keeps no freed memory; the stages share workers, so it would add up."""
    if not hasattr(ctypes.CDLL(None), "malloc_trim"):
        pytest.skip("another C library than glibc")
    path, functions = "/root/testdata/sf0.1/documents.parquet", []
    docs = spark.read.parquet(path)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: functions.append(f) or self)
    for made in (language_id.keep_identified, simhash_dedup.fingerprints, pii.mask, bpe.encode):
        made(docs)
    assert len(functions) == 4
    kept = []
    for f, names in zip(functions, (docs.columns, ["doc_id", "text"], docs.columns, ["doc_id", "text"])):
        # Nothing else holds the rows when the function ends.
        assert sum(b.num_rows for b in f(iter(pq.read_table(path, columns=names).slice(0, 2000).combine_chunks().to_batches()))) > 1000
        before = _anonymous()
        pa.default_memory_pool().release_unused()
        ctypes.CDLL(None).malloc_trim(0)
        kept.append(before - _anonymous())
    assert max(kept) < 30, kept


def test_run_leaves_one_stage(spark):
    import pathlib

    from corpuskit.operators.lineage import shared_dir

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_tokens", "token_ids", "round_trip"] and out.count() > 50
    (folder,) = pathlib.Path(shared_dir(spark).removeprefix("file:")).glob("pipeline-*")
    assert [p.name for p in folder.iterdir()] == [corpus_pipeline.STAGES[-2][0]]
