import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_on_odd_documents(spark, odd, none, small, tmp_path):
    for docs in (odd, none):
        now = docs
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, now, small)
            if i < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
                out.write.mode("overwrite").parquet(path := str(tmp_path / f"{docs is none}{i}"))
                now = spark.read.parquet(path)
            else:
                assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns)
                out.count()


def test_run_drops_what_the_stages_reject(spark, small):
    kept = {r.doc_id for r in corpus_pipeline.run(spark, small).select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet")
    marks = spark.read.parquet(f"{small}/labels.parquet")
    good = {r.doc_id for r in marks.where("quality = 1").collect()}
    from tessella.llm import decontamination, near_dedup

    leaked = {r.doc_id for r in decontamination.overlaps(docs, spark.read.parquet(f"{small}/benchmark.parquet")).collect()}
    alone = {r.doc_id for r in near_dedup.near_groups(docs).groupBy("component_id").count().where("count = 1").withColumnRenamed("component_id", "doc_id").collect()}
    assert not kept & leaked
    assert len((good & alone) - leaked - kept) <= 0.03 * len(good)


def test_run_against_plain_stages(spark, small):
    """The rows of run() against stages in plain Python; of the classifier its own decisions are taken."""
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    from tessella.llm import packing, quality
    from tests.llm.test_dedup import LOWER, brute
    from tests.llm.test_text_operators import every_window, gapless

    read = lambda t: spark.read.parquet(f"{small}/{t}.parquet")
    rows = [(r.doc_id, r.text or "") for r in quality.keep_good(read("documents"), read("labels")).collect()]
    last = {}
    for i, t in rows:
        last[t.translate(LOWER)] = max(i, last.get(t.translate(LOWER), i))
    rows = [(i, t) for i, t in rows if i in set(last.values())]
    reached = brute(rows, 80)
    rows = [(i, t) for i, t in rows if reached[i][1] == i]
    leaked = {i for i, _ in every_window(rows, [(r.item_id, r.text) for r in read("benchmark").collect()])}
    rows = {i: t for i, t in rows if i not in leaked}
    got = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in got} == set(rows)
    exact = Tokenizer.from_file(packing.default_tokenizer())
    for i, text in rows.items():
        ids = np.array([*exact.encode(text, add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        assert [r.start for r in pieces] == [sum(r.length for r in pieces[:k]) for k in range(len(pieces))] and sum(r.length for r in pieces) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)
    gapless(got, packing.CAPACITY)


def test_scopes_are_discarded(spark, tmp_path):
    from tessella.llm import scratch

    with scratch.scope() as work:
        inner = scratch.materialize(spark.range(3).toDF("n"), "inner")
    outer = scratch.materialize(inner, "outer", "outer-table")
    assert work in inner.inputFiles()[0] and work not in outer.inputFiles()[0]
    scratch.discard(spark, work)
    assert outer.count() == 3
    import os

    assert not os.path.exists(inner.inputFiles()[0].removeprefix("file:").removeprefix("//"))
    scratch.discard(spark, "outer-table")


def test_decisions_hold_for_single_rows(spark):
    """Ids that are null or stand for two texts neither save a row nor cost another one."""
    from tessella.llm import decontamination, exact_dedup, near_dedup

    long = " ".join(f"w{i}" for i in range(60))
    bad = " ".join(f"b{i}" for i in range(20))
    rows = [(1, long), (1, long), (1, "one of its own"), (2, bad), (2, "two of its own"), (None, bad), (None, bad), (None, long + " end"), (3, long)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string")
    items = spark.createDataFrame([(1, bad)], "item_id long, text string")

    def kept(out):
        assert out.columns == docs.columns
        return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)

    own = [(1, "one of its own"), (2, "two of its own")]
    assert kept(exact_dedup.drop_copies(docs)) == sorted([*own, (3, long), (2, bad), (None, bad), (None, long + " end")], key=str)
    assert kept(near_dedup.drop_near_copies(docs)) == sorted([*own, (1, long), (2, bad)], key=str)
    assert kept(decontamination.drop_contaminated(docs, items)) == sorted([*own, *[x for x in rows if x[1].startswith(long)]], key=str)


def test_queries_have_sound_names():
    from tessella.llm import queries

    names = queries.queries()
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 11))
    assert set(queries.oracle_sql()) <= set(names)
