"""Substring, exact and near-duplicate removal against plain versions, and their defined edge cases."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fathomline.llm import exact, graph, jaccard, substring, wordhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus():
    """Texts with shared passages, near and exact copies, odd white space, nulls, empties and one long text."""
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocab) for _ in range(45)]
    texts = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 5, 25, 60, 90]))]
        if i % 3 == 0:
            at = rng.randrange(len(w) + 1)
            cut = rng.randrange(18, 45)
            w[at:at] = passage[rng.randrange(0, 10):][:cut]
        if i % 7 == 0:
            w = w + w
        texts.append(rng.choice([" ", "\n", "  \t"]).join(w))
    texts += [texts[9], texts[9] + " tail", " " + texts[12], None, "", "   ", "Ünï cödé " * 30, "THE SAME case", "the same CASE"]
    texts.append(" ".join(rng.choice(vocab) for _ in range(6000)))
    return [(i * 3, t) for i, t in enumerate(texts)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------------------------------------------------- substrings
def plain_repeats(rows, window=20):
    seen, out = set(), {}
    for doc, text in sorted(rows):
        w = WORDS.findall(text or "")
        gone = set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i: i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = [x for i, x in enumerate(w) if i not in gone]
        out[doc] = (len(w), len(gone), " ".join(kept))
    return out


def test_repeats_are_cut_as_by_comparing_all_windows(spark, corpus):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(frame(spark, corpus)).collect()}
    assert got == plain_repeats(corpus)
    assert sum(v[1] for v in got.values()) > 100


def test_spans_are_maximal_and_cover_what_is_removed(spark, corpus):
    for r in substring.remove_repeats(frame(spark, corpus)).collect():
        spans = [(s.start, s.end) for s in r.spans]
        assert sum(e - s for s, e in spans) == r.n_removed
        assert all(e - s >= 20 for s, e in spans)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_repeats_over_many_partitions(spark, corpus):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    passage = " ".join(f"p{i}" for i in range(24))
    rows = corpus + [(1000 + i, f"a{i} b{i} {passage} c{i}") for i in range(200)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(frame(spark, rows).repartition(7)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == plain_repeats(rows)


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"x{i}" for i in range(25))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (2, "short")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in substring.remove_repeats(frame(spark, rows)).collect())
    assert got == [(False, 1, 25, 0), (False, 1, 25, 0), (False, 2, 1, 0), (False, 2, 25, 25), (False, 3, 0, 0), (True, 0, 25, 0)]


def test_stretches_that_collide_in_the_hash_are_no_repeats():
    def batch(*rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["anchor", "stretch", "proof", "doc", "w0", "n"])

    same, collide = [(1, 5, 9, d, 0, 3) for d in (1, 2)], [(1, 5, 9, 1, 0, 3), (1, 5, 10, 2, 0, 3)]
    for parts in (lambda rows: [batch(*rows)], lambda rows: [batch(r) for r in rows]):
        def kinds(rows, parts=parts):
            return sorted((k, d) for b in substring._sort_out(parts(rows)) for k, d in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))

        assert kinds(same) == [(0, 2), (1, 1)]
        assert kinds(collide) == [(1, 1), (1, 2)]


def test_windows_that_collide_in_the_hash_are_no_repeats(spark):
    rows = [(5, 9, 1, 0, False), (5, 10, 2, 0, False), (5, 10, 3, 4, False), (6, 9, 3, 7, False), (5, 9, 1, 8, True)]
    windows = frame(spark, rows, "hash long, proof long, doc long, w int, again boolean")
    assert sorted((r.doc, r.w) for r in substring._later(windows).collect()) == [(1, 8), (3, 4)]


def test_check_sums_follow_the_words_wherever_they_stand():
    rng = random.Random(5)
    words = [rng.choice(["a", "b", "ab", "ba", "é", "long" * 400]) for _ in range(400)]
    # words that differ but collide in any polynomial over bytes modulo 2^64 have a check sum of their own
    thue = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 12))
    words[100:100] = [thue, thue.translate({97: "b", 98: "a"})]
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    starts, ends, _ = wordhash.word_spans(data, np.array([0, len(data)]))
    sums = wordhash.check_prefixes(data, starts, ends)
    hashes = wordhash.word_hashes(data, starts, ends)
    for n in (1, 2, 3):
        at = np.arange(len(words) - n + 1)
        found = {}
        for k, c in zip(at, wordhash.span_check(sums, at, at + n).tolist()):
            assert found.setdefault(c, tuple(words[k: k + n])) == tuple(words[k: k + n])
        assert len(found) == len({tuple(words[k: k + n]) for k in at})
    assert hashes[100] == hashes[101]


def test_no_rows(spark):
    none = frame(spark, [])
    assert substring.remove_repeats(none).count() == 0
    assert jaccard.similar_groups(none).count() == 0
    assert exact.keep_first(none).count() == 0


# --------------------------------------------------------------------------------------------------------------- exact
def test_filter_holds_its_keys_and_few_others():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 10, 1000, 60_000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        built = exact.build_filter(keys)
        assert exact.may_contain(keys, built).all()
        other = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
        assert exact.may_contain(other, built).mean() < 0.02
        if n == 60_000:
            assert len(built[3]) < 1.4 * n


def plain_exact(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(doc)
    return {(doc, hashlib.sha256(t.encode()).hexdigest()): (min(ids), len(ids)) for t, ids in groups.items() for doc in ids}


def test_equal_texts_are_found_over_snapshot_and_batch(spark, corpus):
    batch, snapshot = exact.split_snapshot(frame(spark, corpus))
    assert batch.count() and snapshot.count()
    got = {(r.id, r.digest): (r.keep_id, r.group_size) for r in exact.deduplicate(batch, snapshot).collect()}
    assert got == plain_exact(corpus)


def test_first_batch_against_an_empty_snapshot(spark, corpus):
    docs = frame(spark, corpus)
    got = {(r.id, r.digest): (r.keep_id, r.group_size) for r in exact.deduplicate(docs, docs.where("false")).collect()}
    assert got == plain_exact(corpus)


def test_kept_rows_carry_all_columns_whatever_their_names(spark):
    rows = [(4, "a  b", "p", 1), (2, "a b", "q", 2), (2, "a b", "q", 2), (None, "c", "r", 3), (None, "c", "r", 3), (7, None, "s", 4), (9, "", "t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, _own int")
    got = sorted(((r.doc_id or 0), r.digest) for r in exact.keep_first(docs).collect())
    assert got == [(0, "r"), (2, "q"), (7, "s")]
    assert exact.keep_first(docs).columns == docs.columns


# ------------------------------------------------------------------------------------------------------------- jaccard
def plain_groups(rows, num, shingle):
    sets = {}
    for doc, text in rows:
        w = re.findall(WORDS, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[doc] = {tuple(w[i: i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def edited(seed, n=160):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(50)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 6, 11, 24, 70]))] for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 1, 1, 2])):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize(("num", "shingle", "block"), [(90, 3, 256), (80, 5, 6), (60, 2, 6)])
def test_groups_are_those_of_comparing_all_pairs(spark, corpus, monkeypatch, num, shingle, block):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)  # small blocks send groups through all rounds
    rows = corpus + [(i + 5000, t) for i, t in edited(num)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_groups(frame(spark, rows), num, 100, shingle).collect()}
    assert got == plain_groups(rows, num, shingle)


def test_index_entries_meet_for_every_linked_pair():
    rng = random.Random(5)
    for num in (90, 80, 50):
        schemes = jaccard.Schemes(num, 100)
        for _ in range(400):
            n = rng.randrange(1, 60)
            a = {rng.getrandbits(63) for _ in range(n)}
            b = set(a)
            for _ in range(rng.randrange(0, 8)):
                b.discard(rng.choice(sorted(b))) if b and rng.random() < 0.5 else b.add(rng.getrandbits(63))
            if not b or a == b or 100 * len(a & b) < num * len(a | b):
                continue
            x, y = (jaccard.index_entries(np.array(sorted(s), dtype=np.uint64), schemes.of(len(s))) for s in (a, b))
            assert set(x.tolist()) & set(y.tolist()), (num, len(a), len(b))


def test_one_of_each_group_stays(spark):
    text = " ".join(f"k{i}" for i in range(80))
    rows = [(5, text, 1), (3, text + " z", 2), (9, "other words here", 3), (None, text, 4), (11, None, 5), (12, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep int")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.rep for r in kept.collect()) == [2, 3, 4, 5, 6]


def test_components_by_rounds_equal_those_of_one_task(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(190)] + [(i, i + 1) for i in range(900, 960)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    one = {r.node: r.component for r in graph.components(df).collect()}
    assert one == {r.node: r.component for r in graph.components(df, one_task=0).collect()}
    assert one[955] == 900 and one[7] <= 7
    assert graph.components(df.where("false")).count() == 0


def test_word_hashes_do_not_depend_on_place():
    import pyarrow as pa

    (_, data, bounds), = wordhash.text_chunks(pa.array(["a bb\tccc", None, "bb ccc", "a"]))
    starts, ends, words = wordhash.word_spans(data, bounds)
    h = wordhash.word_hashes(data, starts, ends)
    assert words.tolist() == [0, 3, 3, 5, 6]
    assert h[1] == h[3] and h[2] == h[4] and h[0] == h[5] and len(set(h.tolist())) == 3
