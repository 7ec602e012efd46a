"""Language-model scores, ranked search and vector codes against plain Python."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fathomline.llm import codes, lexical, recurrent

FOLDER = "/root/testdata/sf0.001"


# ------------------------------------------------------------------------------------------------------------ op11
def small_vocabulary(words=40, tail=30, seed=3):
    rng = np.random.default_rng(seed)
    names = [recurrent.END, *(b"w%d" % i for i in range(words + tail - 1))]
    counts = np.sort(rng.integers(2, 400, len(names)))[::-1].astype(float)
    return recurrent.Vocabulary.of(names, counts, int(counts.sum()) + 50, len(names) + 30, 20, 4)


@pytest.fixture
def few_words(monkeypatch):
    monkeypatch.setattr(recurrent, "LEARNED", 40)
    monkeypatch.setattr(recurrent, "CLASSES", 5)
    monkeypatch.setattr(recurrent, "ENDINGS", 4)


def plain_log_probability(net, symbols, upto=None):
    """One token after the other, in double precision, without batches or windows."""
    x, u, wc, bc, ww, bw = (p.astype(np.float64) for p in net.parts)
    h, k, total, before = np.zeros(recurrent.UNITS), recurrent.UNITS, 0.0, net.start
    for y in symbols[:upto]:
        own = u @ h
        z, r = (1 / (1 + np.exp(-(x[:2 * k, before] + own[:2 * k])))).reshape(2, k)
        h = h + z * (np.tanh(x[2 * k:, before] + r * own[2 * k:]) - h)
        c = net.class_of[y]
        a = wc @ h + bc
        total += a[c] - np.log(np.exp(a).sum())
        if c < len(net.bounds) - 1:
            low, high = net.bounds[c], net.bounds[c + 1]
            b = ww[low:high] @ h + bw[low:high]
            total += b[y - low] - np.log(np.exp(b).sum())
        before = y
    return total


def test_network_carries_its_state_through_windows_and_batches(few_words):
    v = small_vocabulary()
    net, rng = recurrent.Network(v), np.random.default_rng(0)
    net.flat[:] += rng.normal(0, 0.3, len(net.flat)).astype(np.float32)
    texts = [rng.integers(0, v.n_symbols, n).astype(np.uint16) for n in (1, 2, 15, 16, 17, 33, 700, 16)]
    column = pa.array([t.tobytes() for t in texts], pa.binary())
    got = np.zeros(len(texts))
    for rows, some in recurrent.lanes(column):
        got[rows] = net.run(some)
    assert np.allclose(got, [plain_log_probability(net, t) for t in texts], rtol=1e-4)


def test_gradient_equals_finite_differences(few_words):
    v = small_vocabulary()
    net, rng = recurrent.Network(v), np.random.default_rng(1)
    net.flat[:] += rng.normal(0, 0.3, len(net.flat)).astype(np.float32)
    texts = [rng.integers(0, v.n_symbols, n).astype(np.uint16) for n in (12, 9, 9, 3)]
    tokens, seen = sum(map(len, texts)), []

    class Keep:
        def step(self, values, gradient, n):
            seen.append(gradient.copy())

    net.run(texts, Keep())
    for i in rng.choice(np.flatnonzero(np.abs(seen[0]) > 1e-4), 60, replace=False):
        kept, loss = net.flat[i], []
        for d in (1e-2, -1e-2):
            net.flat[i] = kept + d
            loss.append(-sum(plain_log_probability(net, t) for t in texts) / tokens)
        net.flat[i] = kept
        assert math.isclose((loss[0] - loss[1]) / 2e-2, seen[0][i], rel_tol=0.03, abs_tol=2e-5)


def test_probabilities_of_all_events_add_up_to_one(few_words):
    v = small_vocabulary()
    net, rng = recurrent.Network(v), np.random.default_rng(2)
    net.flat[:] += rng.normal(0, 0.5, len(net.flat)).astype(np.float32)
    history = [3, 41, 7]
    before = plain_log_probability(net, history)
    p = {s: math.exp(plain_log_probability(net, [*history, s]) - before) for s in range(v.n_symbols)}
    assert math.isclose(sum(p.values()), 1, rel_tol=1e-6)
    words = sum(p[v.symbol[i]] * 10 ** v.within[i] for i in range(len(v.number)))
    outside = p[v.n_symbols - 1]  # the unknown, and the known words outside the dictionary by their counts
    assert math.isclose(words + outside * (v.unknown + (1 - v.unknown)), 1, rel_tol=1e-6)


def test_base_scores_and_counts_against_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(["The cat\tsat", "the the CAT", None, "", " \n ", "a b c d é É", "zebra yak", "x" * 5000, "cat " * 3000, "cat"] * 4)]
    rows += [(None, "the cat"), (3, "the cat"), (3, "the cat")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    got = recurrent.scores(docs).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w] + [None]
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
                   round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), 6)) for i, t in rows)
    assert sorted((str(r["doc"]), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def test_words_beyond_the_dictionary_are_counted_all_the_same(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "DICTIONARY", 20)
    monkeypatch.setattr(recurrent, "HELD_WORDS", 10)
    monkeypatch.setattr(recurrent, "TOKENS", 20_000)  # several trainers, averaged
    monkeypatch.setattr(recurrent, "FAN_IN", 2)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r["doc"]: r for r in recurrent.scores(docs).collect()}
    rows = {r.doc_id: recurrent.words_of(r.text.encode()) + [b""] for r in docs.collect()}
    counts = Counter(w for i, t in rows.items() if not got[i].held_out for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in rows.items():
        assert got[i].n_known == sum(counts[w] > 0 for w in t) and got[i].train_tokens == n
        assert math.isclose(got[i].base_score, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel_tol=1e-9)


def test_held_out_texts_are_likelier_than_by_frequency_alone(spark):
    got = recurrent.scores(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out")
    sums = got.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert sums.s > 0.85 * sums.b


@pytest.mark.parametrize("texts", [[], ["all held out"], [None, "a"]])
def test_nothing_to_learn_from(spark, texts):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = recurrent.scores(spark.createDataFrame(list(zip(held, texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts) and all(r.held_out for r in got)
    assert all(r.n_known == r.train_tokens == r.base_score == r.score == 0 for r in got)


# ------------------------------------------------------------------------------------------------------------ op12
def plain_rank(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, length = len(bags), sum(s for *_, s in bags)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, want in asked.items():
        found = []
        for i, b, size in bags:
            m = 10 + 90 * size * n // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in o for _, o, _ in bags) + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                    for t in want if t in b)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def test_ranking_against_plain_python(spark):
    rng = np.random.default_rng(5)
    words = [f"t{i}" for i in range(30)] + ["Älter", "älter", "x-y", "KK"]
    text = lambda n: " ".join(rng.choice(words, n))
    docs = [(int(i), text(rng.integers(1, 40))) for i in range(60)]
    docs += [(1000 + i, "t1 t2, t3. T1") for i in range(40)]  # one class, by punctuation only different
    docs += [(2000 + i, f"t1 t2 t3 t1{'!' * i}") for i in range(5)] + [(None, "t1 t2 t3 t1"), (1000, "t1 t2 t3 t1"), (5, None), (6, ""), (7, "?!"),
                                                                      (8, "t4 " * 30000)]
    items = [(1, "t1 t2"), (2, text(10)), (3, None), (4, ""), (5, "nowhere"), (6, "T4 t4"), (6, "t9"), (None, "t5 x"), (7, "älter Älter")]
    got = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).withColumn("n", F.lit("n")),
                       spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_rank(docs, items)


def test_blocks_of_items_and_of_scores(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEMS", 3)
    monkeypatch.setattr(lexical, "CELLS", 12)
    monkeypatch.setattr(lexical, "SPREAD", 7)
    rng = np.random.default_rng(6)
    text = lambda n: " ".join(f"t{i}" for i in rng.integers(0, 15, n))
    docs, items = [(i, text(12)) for i in range(90)], [(i, text(5)) for i in range(11)]
    got = lexical.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_rank(docs, items, 4)


def test_ranking_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.rank(docs, items).count() == 0
    assert lexical.rank(items.withColumnRenamed("item_id", "doc_id"), docs.withColumnRenamed("doc_id", "item_id")).count() == 0


def test_equal_bags_are_scored_once(spark):
    """A class with a third of all rows sends no more than the first of its members."""
    docs = spark.range(3000).selectExpr("id as doc_id", "case when id % 3 = 0 then 'a b a' else concat('a w', id) end as text")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = lexical.rank(docs, items)
    assert [tuple(r)[1:3] for r in plan.orderBy("rank").collect()] == [(i + 1, 3 * i) for i in range(10)]
    assert "WindowGroupLimit" in plan._jdf.queryExecution().toString()


# ------------------------------------------------------------------------------------------------------------ op13
def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w: (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    best = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                own.setdefault(best(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, xs in own.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    found = [(i, lab, [best(cut(v, p), books[p]) for p in range(parts)]) for i, v, lab in kept]
    by_label = Counter()
    for _, lab, b in found:
        by_label[lab] += sum(d for d, _ in b)
    return sorted(((i, "".join(f"{e:02x}" for _, e in b), sum(d for d, _ in b), by_label[lab]) for i, lab, b in found), key=str), books


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit("x")).withColumn("pos", F.lit(0))


def same_codes(spark, rows, **kw):
    coded, books = codes.compress(vectors_of(spark, rows), **kw)
    got = sorted(((r.id, r.code, r.error, r.label_error) for r in codes.label_errors(coded).collect()), key=str)
    want, plain_books = plain_codes(rows, **{k: v for k, v in kw.items() if k != "scale"})
    assert got == want and [[[int(x) for x in e] for e in b] for b in books] == plain_books


def test_codes_against_plain_python(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(0, 0.4, 16).round(int(rng.integers(1, 4)))], int(i % 3) if i % 7 else None) for i in range(150)]
    rows += [(500 + i, [0.25] * 16, 9) for i in range(80)]  # one hot vector
    rows += [(None, [0.5] * 16, 1), (3, [0.5] * 16, 1), (3, [-0.5] * 16, None), (900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] + [0.0] * 15, 1),
             (903, [float("inf")] + [0.0] * 15, 2), (904, [-0.0] * 16, 2)]
    same_codes(spark, rows)


def test_codes_with_few_rows_and_large_components(spark):
    rng = np.random.default_rng(8)
    same_codes(spark, [(i, [float(x) for x in rng.normal(0, 1, 8)], None) for i in range(5)])
    same_codes(spark, [(i, [float(x) for x in rng.normal(0, 1e5, 8).round(2)], 1) for i in range(40)], rounds=2)


def test_vectors_of_other_lengths_and_none_at_all(spark):
    rows = [(i, [0.1 * i] * 16, 1) for i in range(6)] + [(10, [0.5] * 24, 1), (11, [0.5] * 3, 1), (12, [], 1)]
    coded, _ = codes.compress(vectors_of(spark, rows))
    assert sorted(r.id for r in coded.collect()) == list(range(6))
    coded, books = codes.compress(vectors_of(spark, [(1, None, 1)]))
    assert coded.count() == 0 and books == [] and codes.label_errors(coded).columns == ["id", "label", "code", "error", "label_error"]


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_a_walk_equals_comparing_all(block):
    rng = np.random.default_rng(block)
    parts = np.unique(rng.integers(-4, 5, (400, 5)), axis=0)
    book = rng.integers(-4, 5, (6, 5))
    walk = codes.Walk(book)
    got = [walk.nearest(parts[i: i + block]) for i in range(0, len(parts), block)]
    d = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (np.concatenate([e for e, _ in got]) == d.argmin(axis=1)).all() and (np.concatenate([x for _, x in got]) == d.min(axis=1)).all()


# ------------------------------------------------------------------------------------------------------------- op2
@pytest.mark.parametrize("known", [0, 10])
def test_a_batch_far_larger_than_its_snapshot_is_screened_in_many_buckets(spark, monkeypatch, known):
    from fathomline.llm import exact
    monkeypatch.setattr(exact, "KEYS_PER_FILTER", 40)
    screened, screen = [], exact.screen
    monkeypatch.setattr(exact, "screen", lambda incoming, filters: screened.append(incoming) or screen(incoming, filters))
    text = lambda i: f"text {i % 700}"
    frame = lambda ids: spark.createDataFrame([(i, text(i)) for i in ids], "doc_id long, text string")
    got = exact.deduplicate(frame(range(known, 1000)), frame(range(known))).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in got) == [(i, i % 700, 2 if i % 700 < 300 else 1) for i in range(1000)]
    assert bool(screened) == bool(known)
    for incoming in screened:
        assert max(r["count"] for r in incoming.groupBy("bucket").count().collect()) < 120
