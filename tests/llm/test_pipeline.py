"""The pipeline and the registered queries at the smallest scale."""

import hashlib
import itertools
import re
import threading
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import duckdb
import numpy as np
import pandas as pd
import pytest
import test_operators as ops

import corpus_pipeline
from polyglotmill.llm import common, langid, mixing, queries

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert set(docs.columns) < set(out.columns) and len(out) and out.doc_id.is_unique
    assert out.groupby("shard").size().agg(lambda s: s.max() - s.min()) <= 1
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_match_brute_force(spark):
    """Every stage of the pipeline on its own input, against a version in plain Python over the same rows.

    The centroids and floors are the fitted ones; which row goes where follows from the descriptions.
    """
    def table(df):
        return sorted(df.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text or ""))

    source = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(90_001, None, "en", "s", None), (90_002, "12 !!", None, None, 5), (90_003, "", "en", "s", 0), (None, "the words of a text that has no number in it", "en", "s", 44)]
    docs = common.cut(source.unionByName(spark.createDataFrame(odd, source.schema)).unionByName(source.limit(2)))
    before = table(docs)

    model = langid.fit(docs)
    now = common.settled(spark, lambda: corpus_pipeline.language_id(spark, docs, SF))
    lettered = [r for r in before if r.text and langid.has_letter(r.text)]
    want = []
    for r, (lang, cosine) in zip(lettered, ops.brute_language([r.text for r in lettered], model)):
        clean = " ".join(re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]", " ", r.text).split())
        kind = int(langid.length_class(np.array([len(clean.encode())]))[0])
        if abs(cosine - model.floor[model.languages.index(lang), kind]) > 1e-4 and cosine >= model.floor[model.languages.index(lang), kind]:
            want.append((r.doc_id, r.text, lang, r.source, r.n_chars))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in now.collect()) and len(want) < len(before)

    before, docs = table(now), now
    now = common.settled(spark, lambda: corpus_pipeline.near_dedup(spark, docs, SF))
    one = {r.doc_id: r for r in before if r.doc_id is not None}  # the repeated rows are equal
    classes = ops.exact_classes([(i, ops.words(r.text)) for i, r in sorted(one.items())])
    want = [tuple(r) for i, r in one.items() if classes[i] == i] + [tuple(r) for r in before if r.doc_id is None]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in now.collect()) and len(want) < len(before)

    before, docs = table(now), now
    now = common.settled(spark, lambda: corpus_pipeline.decontamination(spark, docs, SF))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {}
    for name, item in items:
        w = ops.words(item)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(name)
    want = []
    for r in before:
        w = ops.words(r.text)
        hit = [False] * len(w)
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit[j : j + n] = [True] * n
        if sum(hit) > 0.5 * len(w):
            continue
        text, runs, k = r.text, [], 0
        for value, group in itertools.groupby(hit):
            n = len(list(group))
            runs += [(k, k + n)] if value else []
            k += n
        places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
        short = {len(k) for k in windows if len(k) < 10}
        runs = [(a, b) for a, b in runs if b - a >= 10 or 3 <= b - a < 10 and short]
        if runs:
            left, at = [], 0
            for a, b in runs:
                left.append(text[at : places[a][0]].strip(" \t\n\r\x0b\x0c"))
                at = places[b - 1][1]
            left.append(text[at:].strip(" \t\n\r\x0b\x0c"))
            text = " ".join(x for x in left if x)
        want.append((r.doc_id, text, r.lang, r.source, len(text) if runs else r.n_chars))
    got = now.collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got) and any(x[1] != r.text for x, r in zip(sorted(want, key=str), sorted(before, key=str))) | (len(want) < len(before))

    before, docs = table(now), now
    now = common.settled(spark, lambda: corpus_pipeline.mixture(spark, docs, SF))
    found, _ = mixing.marginals(docs)
    goal = {(mixing.DIMENSIONS.index(r.dim), r.value): r.target for r in found.collect()}
    cell, cells = {}, {}
    for r in before:
        n, lines = len(re.findall(r"[^ \t\n\r]+", r.text)), r.text.count("\n") + 1
        topic = "short" if n < 60 else "listed" if n < 12 * lines else "long" if n >= 800 else "prose"
        cell[str(tuple(r))] = (r.source or "(none)", r.lang or "(none)", topic)
        cells[cell[str(tuple(r))]] = cells.get(cell[str(tuple(r))], 0) + n
    p = ops.brute_rake(cells, goal, mixing.KEEP_SHARE, mixing.ROUNDS)
    want = [r for r in before if int(hashlib.md5(f"{mixing.SEED}:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16) / 2**32 < p[cell[str(tuple(r))]]]
    assert sorted(map(str, map(tuple, want))) == sorted(str(tuple(r)) for r in now.collect()) and 0 < len(want) < len(before)

    before = table(now)
    got = corpus_pipeline.shards(spark, now, SF).collect()
    assert sorted(str(tuple(r)) for r in before) == sorted(str(tuple(r)[:5]) for r in got)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min([*sizes.values(), 0] if len(sizes) < 40 else sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())


def test_first_stage_on_rows_without_letters(spark):
    rows = spark.createDataFrame([(1, None, "en", "s", None), (2, "12", None, None, 2), (3, "some words of text", "en", "s", 18)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in langid.keep_known(rows, langid.fit(rows)).collect()] == [3]


def test_stages_of_two_threads_keep_their_tables(spark):
    started, go_on = threading.Event(), threading.Event()

    def slow():
        held = common.cut(spark.range(5))
        started.set()
        go_on.wait(60)
        return held.selectExpr("id * 2 as id")

    with ThreadPoolExecutor(2) as pool:
        one = pool.submit(common.settled, spark, slow)
        started.wait(60)
        two = common.settled(spark, lambda: common.cut(spark.range(3)))
        outer = common.settled(spark, lambda: common.settled(spark, lambda: common.cut(spark.range(4))).unionByName(common.cut(spark.range(1))))
        go_on.set()
        assert sorted(r.id for r in one.result().collect()) == [0, 2, 4, 6, 8]
    assert two.count() == 3 and outer.count() == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "labels", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    pd.testing.assert_frame_equal(got[columns].sort_values(columns).reset_index(drop=True), want[columns].sort_values(columns).reset_index(drop=True), check_dtype=False)
