"""Findings of round 3: what the operators write and move."""

import os
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pitchstar.llm import collocations, common, minhash_dedup, warc, wordcodes


def test_warc_archives_are_smaller_than_their_payloads(spark, tmp_path):
    pages = [(i, f"http://h/{i}", f"<p>{i}</p>" + "<li>some words of a page</li>" * 200) for i in range(40)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    warc.write_archive(warc.records(df), str(tmp_path / "w"))
    files = [f for f in os.listdir(tmp_path / "w") if f.startswith("part-")]
    assert files and sum(os.path.getsize(tmp_path / "w" / f) for f in files) < sum(len(h) for _, _, h in pages) / 4
    got = warc.read_archive(spark, str(tmp_path / "w")).collect()
    assert sorted((r.id, r.payload) for r in got) == [(i, h) for i, _, h in pages]


def test_near_duplicates_shuffle_texts_of_resembling_pairs_only(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"c{i}" for i in range(60)]
    rows = [(i, " ".join(base + [f"w{rnd.randrange(10 ** 9)}" for _ in range(45)])) for i in range(60)]
    long = [f"x{i}" for i in range(100)]
    rows += [(100, " ".join(long)), (101, " ".join([*long, "end"])), (102, " ".join([*long, "end", "too"])), (102, "twice"), (None, " ".join(["pre", *long]))]
    texts = []

    def cut(df, keep=None):
        out = common.cut(df, keep)
        if out.columns == ["id", "text"]:
            texts.append(out.count())
        return out

    monkeypatch.setattr(minhash_dedup, "cut", cut)
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=1, percent=80).collect()
    assert sum(texts) <= 12  # not those of documents alike by 40 %
    assert sorted((r.id if r.id is not None else -1, r.component) for r in got) == sorted(
        [(i, i) for i in range(60)] + [(100, 100), (101, 100), (102, 100), (102, 100), (-1, 100)])


def test_id_filter_lets_every_asked_id_through(spark):
    ids = spark.createDataFrame([(5,), (-7,), (2 ** 63 - 1,), (5,)], "id long")
    docs = spark.range(-500, 500).union(spark.createDataFrame([(2 ** 63 - 1,)], "id long")).selectExpr("id", "'t' as text")
    got = {r.id for r in docs.mapInArrow(minhash_dedup.asked(*minhash_dedup.id_filter(ids)), "id long, text string").collect()}
    assert got >= {5, -7, 2 ** 63 - 1} and len(got) < 200


def test_collocations_keep_one_stream_and_release_each_level(spark, monkeypatch):
    streams, seen = [], []

    def cut(df, keep=None):
        out = common.cut(df, keep)
        if out.columns == ["slice", "stream", "words"]:
            streams.append(keep[-1])
        return out

    def release(session):
        seen.append(sum(os.path.exists(p.removeprefix("file:")) for p in streams))

    monkeypatch.setattr(collocations, "cut", cut)
    monkeypatch.setattr(collocations, "release", release)
    rows = [("en", "a b c d e f."), ("en", "a b c d e g."), ("de", "a b. x y")] * 3
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(2), least=3).collect()
    assert ("en", "a b c d e", 6) in {(r.lang, r.phrase, r.a) for r in got} and ("de", "x y", 3) in {(r.lang, r.phrase, r.a) for r in got}
    assert len(streams) == 4 and len(seen) >= 5 and max(seen) == 1


def test_pipeline_releases_each_stage(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    calls = []
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda s, docs, sf_dir: docs) for n in "abc"])
    monkeypatch.setattr(corpus_pipeline, "release", calls.append)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1 and len(calls) == 2


def test_squeezed_arrays_come_back():
    rnd = np.random.default_rng(3)
    for kind in (np.uint8, np.uint16, np.int32, np.int64):
        for n in (0, 1, 3, 50000):
            values = rnd.integers(0, 250, n).astype(kind)
            got = wordcodes.expand(wordcodes.squeeze(values), kind)
            assert got.dtype == kind and got.tolist() == values.tolist()
    table = np.arange(-6, 6).reshape(3, 4)
    assert wordcodes.expand(wordcodes.squeeze(table.T)).reshape(4, 3).tolist() == table.T.tolist()


def test_collocations_move_streams_compressed():
    rnd = np.random.default_rng(4)
    text = " ".join(f"w{i}" for i in np.minimum(rnd.zipf(1.3, 40000), 5000))
    _, stream = collocations._code_slice(1, "en", [pa.array([text], pa.large_string())])
    assert len(stream.column("stream")[0].as_py()) < 2 * 40000  # two bytes a word, where codes have four


def level(streams):
    """Slices of a level of single words, each with ranks of its own."""
    out = []
    for number, ids in enumerate(streams):
        words, place = np.unique(ids, return_inverse=True)
        out += collocations._streams(number, place + 1, words.reshape(-1, 1)).to_batches()
    return out


def test_collocations_send_blocks_of_cells(monkeypatch):
    rnd = np.random.default_rng(5)
    streams = [np.minimum(rnd.zipf(1.4, 3000), 400) for _ in range(12)]
    want = Counter(p for s in streams for p in zip(s[:-1].tolist(), s[1:].tolist()))
    seen = np.full((1 << 16) // 8, 255, np.uint8)
    for gather, most in ((1 << 20, 8), (1, 12 * 8)):  # all slices of the task at once, or each alone
        monkeypatch.setattr(collocations, "GATHER", gather)
        rows = pa.Table.from_batches(collocations.counter(1, 16, seen, 3)(level(streams)))
        assert 8 <= rows.num_rows <= most and len(want) > 1000
        got = {}
        for block in set(rows.column("block").to_pylist()):
            of = collocations.summed(1, 20)(rows.filter(pa.compute.equal(rows.column("block"), block)))
            got |= {(r["w1"], r["w2"]): r["f"] for r in of.to_pylist()}
        assert got == {p: n for p, n in want.items() if n >= 20}
    assert list(collocations.counter(1, 16, np.zeros_like(seen), 3)(level(streams))) == []


def test_buckets_of_tasks_are_added_up(spark, monkeypatch):
    rnd = np.random.default_rng(6)
    streams = [np.minimum(rnd.zipf(1.4, 2000), 300) for _ in range(6)]
    rows = [tuple(b.to_pylist()[0].values()) for b in level(streams)]
    df = spark.createDataFrame([(n, bytearray(s), bytearray(w)) for n, s, w in rows], "slice long, stream binary, words binary").repartition(5)
    want = Counter(p for s in streams for p in zip(s[:-1].tolist(), s[1:].tolist()))
    total = np.zeros(1 << 20, np.int64)
    np.add.at(total, collocations.buckets(np.array(list(want)), 20), np.array(list(want.values())))
    for parts in (256, 2):
        monkeypatch.setattr(collocations, "PARTS", parts)
        got = collocations.passing(df, 1, 20, 30)
        assert np.unpackbits(got, bitorder="little").tolist() == (total >= 30).astype(int).tolist()


def test_words_that_may_be_frequent_are_sent_to_the_join(spark):
    words = spark.range(3000).selectExpr("'en' lang", "concat('w', id) word")
    for bits in (4, 16):
        at = F.pmod(F.xxhash64("lang", "word"), F.lit(1 << bits)) + 1
        seen = collocations.frequent(words.where("word rlike '^w..$'"), at, bits)
        got = {r.word for r in words.withColumn("at", at).mapInArrow(collocations.sought(seen), "lang string, word string").collect()}
        assert got >= {f"w{i}" for i in range(10, 100)} and (bits == 4 or len(got) < 150)
