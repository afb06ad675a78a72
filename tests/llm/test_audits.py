"""Language model scores, divergence of sources and interactions of filters against brute force."""

import itertools
import math
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from polyglotmill.llm import divergence, filter_audit, lm

DOC = "doc_id long, text string, lang string, source string"


# ---- filters


def brute_audit(docs, labels):
    """Every order applied to every document."""
    texts = [(i, t or "", lang or "") for i, t, lang, _ in docs]
    first = {}
    for i, t, _ in texts:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    fails = []
    for i, t, lang in texts:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        own = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        fails.append((lang, own + "E" * (i is not None and i > first[t]), i in good, i in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {x[0] for x in fails}:
            left = [x for x in fails if x[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                row = [len(left), len(here), sum(f in x[1] for x in gone), sum(x[0] == part and x[1] == f for x in fails), sum(x[2] for x in here), sum(x[3] for x in here)]
                out[part, order, step] = row
                shapley[part, f] += len(here)
                gone += here
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_matches_brute_force(spark):
    rng = random.Random(2)
    pool = ["plain words of a text", "LOUD TEXT", "a # b", " ".join(f"w{i}" for i in range(250)), "same " * 300, "Same Äß " * 120 + "|", "", " \t\n ", "x" * 40 + "ABC", " odd space " * 110]
    docs = [(i, rng.choice(pool) + rng.choice(["", "", f" {i}"]), rng.choice(["en", "de", "", None]), "s") for i in range(300)]
    docs += [(900, None, "en", "s"), (901, "", "en", "s"), (None, "plain words of a text", "en", "s"), (None, "plain words of a text", "en", "s"), (5, docs[5][1], docs[5][2], "s"), (5, "another text of one id", "en", "s")]
    docs += [(1000 + k, "copied", "en", "hot") for k in range(150)] + [(1000, "copied", "en", "hot"), (1000, "copied", "de", "hot")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (1003, 1, 1), (77777, 1, 1)]
    frame = spark.createDataFrame(docs, DOC).repartition(5).withColumn("mask", F.lit("x")).withColumn("n", F.lit(1)).withColumn("part", F.lit("p"))
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit(7)).withColumn("text", F.lit("t"))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(frame, said).collect()}
    assert got == brute_audit(docs, labels) and len(got) == 3 * 600
    assert filter_audit.audit(frame.where("false"), said).count() == 0
    assert filter_audit.audit(frame.limit(3), said.where("false")).where("good_lost + toxic_lost > 0").count() == 0


def test_parities_invert_exactly(spark):
    rows = [("p", g, t, m, (m * 7 + g + 2 * t) % 11) for m in range(32) for g in (False, True) for t in (False, True)]
    found = spark.createDataFrame(rows, "part string, good boolean, toxic boolean, mask int, n long")
    parity = filter_audit.parity_sums(found)
    assert all(r.sums[0] == sum(x[4] for x in rows if (x[1], x[2]) == (r.good, r.toxic)) for r in parity.collect())
    (row,) = filter_audit.cells(parity).collect()
    assert row.n == [sum(x[4] for x in rows if x[3] == m) for m in range(32)]
    assert row.good == [sum(x[4] for x in rows if x[3] == m and x[1]) for m in range(32)]
    assert row.toxic == [sum(x[4] for x in rows if x[3] == m and x[2]) for m in range(32)]


# ---- divergence


def brute_divergence(docs, min_docs, top):
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        counts[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        own = sorted(s for x, s in groups if x == lang)

        def shares(c):
            size = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // size for t in kept}

        p = {s: shares(counts[lang, s]) for s in own}
        q = shares(sum((counts[lang, s] for s in own), Counter()))
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (item, value) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("min_docs", [1, 3, 10_000])
def test_divergence_matches_brute_force(spark, min_docs):
    rng = random.Random(9)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["É", "é", "Ωmega", "naïve", "\u0080x", "日本", "A", "a"]
    docs = []
    for i in range(160):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "s4", None])
        some = rng.sample(words, 12)
        docs.append((i, rng.choice([" ", ". ", "-1-", "\n"]).join(rng.choice(some) for _ in range(rng.randint(0, 40))), lang, source))
    docs += [(500, None, "en", "empty"), (501, "123 !!", "xx", "a"), (502, None, "xx", "b"), (3, docs[3][1], docs[3][2], docs[3][3]), (None, "wab wab", "en", "s1")]
    docs += [(600 + k, "hot Wab " * 30, "en", "hot") for k in range(80)]
    frame = spark.createDataFrame(docs, DOC).repartition(4).withColumn("term", F.lit("t")).withColumn("rank", F.lit(0)).withColumn("n", F.lit(0)).withColumn("at", F.lit(1))
    got = {tuple(r) for r in divergence.audit(frame, min_docs, 7).collect()}
    assert got == brute_divergence(docs, min_docs, 7)
    assert {r[4] for r in got if r[0] == "xx" and r[2] == "pair"} == {0}
    assert divergence.audit(frame.where("false"), min_docs, 7).count() == 0


def test_shares_are_exact_where_products_leave_64_bits(spark):
    cases = [(0, 5), (1, 1_000), (10**12, 10**13), (9 * 10**14, 10**15 - 7), (3, 7 * 10**15), (10**15 - 6, 10**15)]
    rows = spark.createDataFrame(cases, "c long, size long").select("c", "size", divergence.share("c", "size").alias("p"))
    assert all(r.p == 1 + 10**9 * (r.c + 5) // r["size"] for r in rows.collect())


def test_terms_of_long_texts_are_counted_whole(monkeypatch):
    text = ("Über-word anotheré " * 500 + "x" * 300).encode()
    whole = text.translate(divergence.TERM_TABLE).split()
    monkeypatch.setattr(divergence, "PIECE", 64)
    pieces = [p.split() for p in divergence._pieces(text)]
    assert len(pieces) > 50 and sum(pieces, []) == whole


@pytest.mark.parametrize(("held", "group", "piece"), [(4 << 20, 1 << 20, 4 << 20), (50, 200, 100)])
def test_terms_are_counted_in_arrow_as_by_hand(monkeypatch, held, group, piece):
    """Terms are no Python objects but in texts longer than a piece; sums do not depend on when a task hands on."""
    rng = random.Random(19)
    rows = [("", "", ""), ("en", "s", ""), ("en", "s", None), ("de", "x", "... 12 !"), ("de", "x", "Ä1ä A a")]
    rows += [(rng.choice("ab"), rng.choice("stu"), rng.choice([" ", "7", "\n. "]).join(rng.choice(["Aé", "aé", "日本", "b", "Cc"]) for _ in range(rng.randint(0, 60)))) for _ in range(300)]
    for name, value in (("HELD_TERMS", held), ("GROUP_BYTES", group), ("PIECE", piece)):
        monkeypatch.setattr(divergence, name, value)
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[i : i + 90])], names=["lang", "source", "text"]) for i in range(0, len(rows), 90)]
    got, want, made = Counter(), Counter(), list(divergence._count(iter(batches)))
    for b in made:
        for lang, source, term, n, docs in zip(*(c.to_pylist() for c in b.columns)):
            got[lang, source, term, "n"] += n
            got[lang, source, term, "docs"] += docs
    for lang, source, text in rows:
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for t, n in terms.items():
            want[lang, source, t, "n"] += n
            want[lang, source, t, "docs"] += 1
    assert got == want
    assert len(made) == 1 if held > 1000 else len(made) > 10


def test_postings_travel_once(spark):
    frame = spark.createDataFrame([(i, f"wa w{chr(97 + i % 9)}", "en", f"s{i % 3}") for i in range(90)], DOC)
    plan = divergence.postings(frame, 2)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bExchange\b", plan)) == 1


# ---- language model


def tokens_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + [lm.END]


def brute_scores(docs, model):
    """Each token by itself: counts, the base, and a softmax over the whole vocabulary in double precision."""
    train = Counter(w for _, t, held in docs if not held for w in tokens_of(t))
    n, v, p = sum(train.values()), len(train), model.parameters
    words = len(p.bias) - 1
    ids = {w: i for i, (w, _) in enumerate(model.head[:words])}
    inside = sum(train[w] for w in ids)
    rest = n - inside + v - sum(train[w] > 0 for w in ids) + 1
    out = Counter()
    for doc_id, text, held in docs:
        own, line = tokens_of(text), [words + 1] * lm.CONTEXT
        total = 0.0
        for w in own:
            k = ids.get(w, words)
            vector = sum(p.context[line[-1 - i]].astype(float) * p.place[i] for i in range(lm.CONTEXT))
            scores = p.target.astype(float) @ vector + p.bias
            total += (scores[k] - scores.max() - np.log(np.exp(scores - scores.max()).sum())) / math.log(10)
            total += math.log10((train[w] + 1) / rest) if k == words else 0.0
            line.append(k)
        base = sum(math.log10((train[w] + 1) / (n + v + 1)) for w in own)
        out[doc_id, held, len(own), sum(train[w] > 0 for w in own), n, round(base, 6), round(total, 3)] += 1
    return out


def lm_docs(seed=1):
    """Two languages whose words alternate in fixed ways, and words that are seen once."""
    rng = random.Random(seed)
    docs = []
    for i in range(240):
        kind = rng.choice("ab")
        words = []
        for _ in range(rng.randint(5, 60)):
            words += [f"{kind}{rng.randint(0, 9)}", f"{kind}x", rng.choice([f"rare{rng.randint(0, 400)}", f"{kind.upper()}Y."])]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(words), i % 5 == 0))
    return docs + [(900, None, False), (901, "", True), (902, " \n ", False), (903, "w" * 500 + " W" + "w" * 499, False), (903, "w" * 500, True), (3, docs[3][1], False), (3, docs[3][1], False), (904, "never seen words here a1 ax", True)]


def scored(frame, model):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 3)) for r in lm.score(frame, model).collect())


def close(got, want):
    """Equal but for the last digit of the rounded score."""
    key = lambda r: (r[0], *r[1:5])
    a, b = sorted(got.elements(), key=lambda r: (key(r), r[6])), sorted(want.elements(), key=lambda r: (key(r), r[6]))
    return len(a) == len(b) and all(x[:5] == y[:5] and abs(x[5] - y[5]) < 1e-5 and abs(x[6] - y[6]) < 2e-3 for x, y in zip(a, b))


@pytest.mark.parametrize(("words", "most"), [(12, 20), (40, 1000), (2048, 1 << 18), (1, 1)])
def test_scores_match_brute_force(spark, words, most):
    docs = lm_docs()
    frame = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean").repartition(4).withColumn("token", F.lit("t")).withColumn("n", F.lit(1)).withColumn("score", F.lit(1))
    model = lm.fit(frame.where("not held_out"), words, most)
    assert len(model.head) <= max(most, 1) and len(model.parameters.bias) == min(words, len(model.head)) + 1
    assert close(scored(frame, model), brute_scores(docs, model))


def test_the_model_learns_and_is_normalised(spark):
    docs = lm_docs(4)
    frame = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean").repartition(3)
    model = lm.fit(frame.where("not held_out"), 30, 1000, passes=4)
    rows = [r for r in lm.score(frame, model).collect() if r.held_out and r.n_tokens > 20]
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    start = lm.Model(model.found, model.head, model.n, model.v, lm.Parameters.start(np.exp(model.parameters.bias.astype(float))))
    before = sum(r.score for r in lm.score(frame, start).collect() if r.held_out and r.n_tokens > 20) / sum(r.n_tokens for r in rows)
    assert gain > 0.1 and sum(r.score for r in rows) / sum(r.n_tokens for r in rows) > before + 0.05
    # All classes of a context sum to 1, and within the class of others all seen tokens and one unseen one do.
    size = len(model.parameters.bias)
    for context in ([0, 1], [size, size], [size - 1, 3]):
        p = np.exp(model.parameters.log_probabilities(np.tile(context, (size, 1)), np.arange(size)))
        assert abs(p.sum() - 1) < 1e-4
    n, v = model.others
    tail = [r.n for r in model.found.collect() if bytes(r.token) not in {w for w, _ in model.head[: model.words]}]
    assert (len(tail), sum(tail)) == (v, n) and abs(sum((c + 1) / (n + v + 1) for c in tail) + 1 / (n + v + 1) - 1) < 1e-12


@pytest.mark.parametrize("scale", [0.3, 3, 40])
def test_tables_of_pairs_normalise_every_context(monkeypatch, scale):
    """All contexts by one matrix product, and by themselves in double precision; far apart, a product alone has no digits left."""
    rng = np.random.default_rng(5)
    size = 60
    p = lm.Parameters(rng.normal(0, scale, (size + 1, lm.DIM)).astype(np.float32), np.ones((lm.CONTEXT, lm.DIM), np.float32), rng.normal(0, 1, (size, lm.DIM)).astype(np.float32), rng.normal(-3, 2, size).astype(np.float32))
    before = np.stack(np.meshgrid(np.arange(size + 1), np.arange(size + 1)), axis=-1).reshape(-1, 2)
    tokens = rng.integers(0, size, len(before))
    scores = (p.context.astype(float)[before[:, 0]] + p.context.astype(float)[before[:, 1]]) @ p.target.astype(float).T + p.bias
    most = scores.max(axis=1)
    want = scores[np.arange(len(tokens)), tokens] - most - np.log(np.exp(scores - most[:, None]).sum(axis=1))
    by_itself = []
    monkeypatch.setattr(lm.Parameters, "log_z", lambda self, v, f=lm.Parameters.log_z: by_itself.append(len(v)) or f(self, v))
    digits = 1e-5 + 1e-6 * np.abs(scores).max()  # parameters have single precision
    assert np.allclose(p.log_probabilities(before, tokens), want, rtol=0, atol=digits)
    assert sum(by_itself) == 0 if scale < 1 else sum(by_itself) > 0 if scale > 3 else True
    assert np.allclose(p.direct(before, tokens), want, rtol=0, atol=digits)
    assert "tables" in vars(p) and "tables" not in vars(pickle.loads(pickle.dumps(p)))


def test_equal_partitions_train_to_equal_parameters(spark):
    frame = spark.createDataFrame(lm_docs(2), "doc_id long, text string, held_out boolean").coalesce(2)
    one, two = (lm.fit(frame, 30, 1000) for _ in range(2))
    assert np.array_equal(one.parameters.flat(), two.parameters.flat()) and one.head == two.head


def test_no_training_rows(spark):
    frame = spark.createDataFrame([(1, "a b", True), (2, None, True)], "doc_id long, text string, held_out boolean")
    model = lm.fit(frame.where("not held_out"))
    assert [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in lm.score(frame, model).orderBy("doc_id").collect()] == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert lm.score(frame.where("false"), model).count() == 0


def test_words_of_long_texts(monkeypatch):
    text = b"One two\tTHREE\n\x0b\x0c\r" * 300 + "Äpfel  x \u0085 y ".encode() * 50
    whole = [w for p in lm.pieces(text) for w in p]
    monkeypatch.setattr(lm, "PIECE", 50)
    parts = list(lm.pieces(text))
    assert len(parts) > 50 and sum(parts, []) == whole == tokens_of(text.decode())[:-1]
    a, b = (lm.Sequences({b"one": 0, b"two": 1}, 2) for _ in range(2))
    a.add(whole)
    for p in parts:
        b.add(p)
    assert all(np.array_equal(x, y) for x, y in zip(a.taken(), b.taken()))


def test_head_leaves_out_ties_at_its_end(spark):
    found = spark.createDataFrame([(x.encode(), n) for x, n in [("a", 9), ("b", 5), ("c", 5), ("d", 5), (" ", 1), ("l" * 65, 99)]], "token binary, n long")
    assert lm.head(found, 5) == [(b" ", 1), (b"a", 9)] and lm.head(found, 6) == [(b" ", 1), (b"a", 9), (b"b", 5), (b"c", 5), (b"d", 5)]
