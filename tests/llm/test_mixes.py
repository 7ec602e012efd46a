"""Packing, mixing, embeddings and toxicity: arithmetic against plain versions, held-out accuracy, defined edge cases."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fathomline.llm import common, embeddings, mixing, packing, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


# ------------------------------------------------------------------------------------------------------------- packing
def test_word_by_word_ids_are_those_of_the_tokenizer(spark):
    plain, ours = Tokenizer.from_file(PATH), packing.WordTokenizer(PATH)
    odd = ["", None, " ", "<|endoftext|> x", "a<|endoftext|>b", "I'm it's DON'T", "Ça va? ΑΣ Σ İstanbul ǅ", "a b　c", "\x1c a\x85b", "123 4.5, 中文", "x<|,", ".,", "a.,b ß."]
    texts = odd + [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    want = [np.array(plain.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert ours.encode(texts) == want


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_REMEMBERED", 5)
    small, plain = packing.WordTokenizer(PATH), Tokenizer.from_file(PATH)
    texts = ["one two three four five six seven", "eight nine, ten", "one two"]
    assert [small.encode([t])[0] for t in texts] == [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]


def docs_for_packing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["sun", "moon", "star,", "Sea"]) for _ in range(rng.choice([0, 3, 40, 300]))), rng.choice(["a", "b", "b", None])) for i in range(120)]
    rows += [(500, None, "a"), (500, None, "a"), (7, "again with another text", "b"), (501, "sun " * 3000, "a")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("weights", [None, {"a": 5, "b": 1}, {"a": 1, "b": 1, None: 4}])
def test_every_token_lies_in_one_place(spark, weights):
    rows, docs = docs_for_packing(spark)
    pieces = packing.pack_documents(docs, PATH, length=256, weights=weights).collect()
    by_seq = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and p.length > 0
        by_seq.setdefault(p.sequence_id, []).append(p)
    total = sum(p.length for p in pieces)
    assert sorted(by_seq) == list(range(-(-total // 256)))
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == (256 if s < max(by_seq) else total - 256 * max(by_seq))
    plain = Tokenizer.from_file(PATH)
    want = sorted((i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4").tobytes()) for i, t, _ in rows)
    parts = {}
    for p in pieces:
        parts.setdefault((p.doc_id, p.doc_tokens, p.source), []).append(p)
    got = []
    for (doc, n, _), ps in parts.items():
        whole = b"".join(p.ids for p in sorted(ps, key=lambda p: (p.start, p.sequence_id)))
        got.append((doc, whole)) if len(whole) == 4 * n else got.extend([(doc, whole[: 4 * n])] * (len(whole) // 4 // n))
    assert sorted(got) == want


def test_windows_hold_the_target_proportions(spark):
    _, docs = docs_for_packing(spark)
    pieces = packing.pack_documents(docs, PATH, length=256).toPandas()
    share = pieces.groupby(pieces.source.fillna("-")).length.sum() / pieces.length.sum()
    for s, ps in pieces[pieces.sequence_id < pieces.sequence_id.max()].groupby("sequence_id"):
        got = ps.groupby(ps.source.fillna("-")).length.sum()
        assert all(abs(got.get(k, 0) - 256 * v) < 2 for k, v in share.items()), s


def test_sequences_are_padded_unless_a_power_of_two(spark):
    _, docs = docs_for_packing(spark)
    seqs = packing.sequences(packing.pack_documents(docs, PATH, length=256), 256).collect()
    for s in seqs:
        power = s.n_tokens & (s.n_tokens - 1) == 0
        assert len(s.ids) // 4 == (s.n_tokens if power else 256) and s.padded == len(s.ids) // 4 - s.n_tokens
    assert packing.pack_documents(docs.where("false"), PATH).count() == 0
    crc = packing.with_crc(packing.pack_documents(docs, PATH)).limit(20).collect()
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in crc)


# -------------------------------------------------------------------------------------------------------------- mixing
def test_targets_share_what_capped_sources_leave():
    got = mixing.targets({"a": 10, "b": 100, "c": 100, None: 1000})
    assert got["a"] == 30 and abs(sum(got.values()) - 1210) < 1e-9
    assert got["b"] == 300 or got["b"] < 300
    assert abs(got["b"] / got["c"] - 2) < 1e-9 or got["b"] == 300
    assert mixing.targets({}) == {} and mixing.targets({"x": 0, "y": 5}) == {"x": 0.0, "y": 5.0}


def test_taken_words_meet_the_targets(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 7, 50])), rng.choice(["a", "b", "c", "é", None])) for i in range(400)]
    rows += [(1000, "big " * 2000, "b"), (3, "w", "a"), (3, "w", "a"), (None, "w w", "a"), (1001, None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, w) for i, w in zip(range(60), [5.0, 0.1, None, -1.0, float("nan"), 2.0] * 10)] + [(5, 9.0)], "id long, weight double")
    out = mixing.take(docs, quality).toPandas()
    assert len(out) == len(rows) and (out.taken <= 3 * out["size"]).all()
    sums = out.groupby(out.source.fillna("-")).agg(size=("size", "sum"), said=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (sums["size"] == sums.said).all() and ((sums.taken - sums.target).abs() <= 1).all()
    again = mixing.take(docs.repartition(5), quality).toPandas()
    key = ["doc_id", "mark", "taken"]
    assert sorted(map(str, out[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    assert mixing.take(docs.where("false"), quality).count() == 0


def test_heavier_documents_are_drawn_first(spark):
    docs = spark.createDataFrame([(i, "w " * 10, s) for s in "abc" for i in range(ord(s) * 1000, ord(s) * 1000 + 300)], "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, 8.0 if i % 2 else 1.0) for s in "abc" for i in range(ord(s) * 1000, ord(s) * 1000 + 300)], "id long, weight double")
    out = mixing.take(docs, quality).toPandas()
    c = out[out.source == "c"]
    assert c[c.doc_id % 2 == 1].taken.sum() > 2 * c[c.doc_id % 2 == 0].taken.sum() > 0


def test_the_mixed_table_has_what_is_taken(spark):
    rows = [(i, " ".join(f"t{k}" for k in range(i % 9)), "ab"[i % 2], i) for i in range(60)] + [(70, "  one\ttwo three ", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    took = {r.doc_id: r.taken for r in mixing.take(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {k: v for k, v in took.items() if v}


def test_running_sums_follow_the_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["x", "y", None]), i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i long, v long").repartition(6)
    at, want = 0, {}
    for k, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        want[i] = at
        at += v
    assert {r.i: r.before for r in common.running_sum(df, ["k", "i"], "v", "before").collect()} == want


# ---------------------------------------------------------------------------------------------------------- embeddings
def test_links_are_those_of_comparing_all_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_PIVOT", 40)
    monkeypatch.setattr(embeddings, "HOME_BLOCK", 16)
    monkeypatch.setattr(embeddings, "SEEN_BLOCK", 50)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 8))
    x = np.concatenate([c + rng.normal(scale=rng.choice([0.05, 0.2, 0.6]), size=(25, 8)) for c in centres] + [rng.normal(size=(40, 8))])
    rows = [(i, [float(v) for v in u]) for i, u in enumerate(x)]
    rows += [(900, rows[3][1]), (901, rows[3][1]), (902, [2 * v for v in rows[3][1]])]
    bad = [(950, None), (951, [0.0] * 8), (952, [1.0, None] + [0.0] * 6), (953, [float("nan")] + [1.0] * 7), (954, [float("inf")] + [1.0] * 7), (955, []), (956, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad + [(None, rows[3][1])], "vec_id long, embedding array<double>")
    got = {r.id: (r.n_links, r.component, r.valid) for r in embeddings.near_duplicates(df).collect()}
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    low = np.arange(len(rows))
    while True:
        new = np.array([min(low[k], low[near[k]].min(initial=low[k])) for k in range(len(rows))])
        if (new == low).all():
            break
        low = new
    for k, i in enumerate(ids):
        assert got[i] == (int(near[k].sum()), ids[low[k]], True)
    assert all(got[i][:2] == (0, i) for i, _ in bad)
    assert got[None] == (0, None, False)
    assert embeddings.near_duplicates(df.where("false")).count() == 0


def test_vectors_that_all_cells_see_are_stored_once_and_dealt_by_block(spark, monkeypatch):
    """Random vectors of many dimensions are seen by all cells; one stored row for every cell was what executors could not hold."""
    monkeypatch.setattr(embeddings, "PER_PIVOT", 20)
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) for v in u]) for i, u in enumerate(rng.normal(size=(600, 64)))]
    stored, cut = {}, embeddings.cut_lineage

    def counting(df, name="table"):
        out = cut(df, name)
        stored[name] = out.count()
        return out

    monkeypatch.setattr(embeddings, "cut_lineage", counting)
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert stored["cells"] == 600 and len(got) == 600 and all(r.n_links == 0 and r.valid for r in got)


def test_a_block_counts_dense_links_piece_by_piece(spark, monkeypatch):
    for name, value in (("LEAST_BLOCK", 32), ("SEEN_PIECE", 24), ("HOME_PIECE", 7), ("LINKS", 10), ("NUMBERS", 40), ("PER_PIVOT", 60)):
        monkeypatch.setattr(embeddings, name, value)
    rng = np.random.default_rng(9)
    x = np.concatenate([c + rng.normal(scale=s, size=(60, 8)) for c, s in zip(rng.normal(size=(5, 8)), (0.01, 0.02, 0.2, 0.3, 0.5))]).astype(np.float32)
    rows = [(i, [float(v) for v in u]) for i, u in enumerate(x)]
    got = {r.id: (r.n_links, r.component) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    for _ in range(len(x)):
        low = np.array([min(low[k], low[near[k]].min(initial=low[k])) for k in range(len(x))])
    assert got == {k: (int(near[k].sum()), int(low[k])) for k in range(len(x))} and near.sum() > 6000


# ------------------------------------------------------------------------------------------------------------ toxicity
def test_words_are_seen_through_disguises():
    assert toxicity.normal_form("Idiot!!") == ("idiot", False)
    assert toxicity.normal_form("1d10t") == ("idiot", True)
    assert toxicity.normal_form("i.d.i.o.t") == ("idiot", True)
    assert toxicity.normal_form("stuuuupid") == ("stupid", True)
    assert toxicity.normal_form("555-5010") == ("", False)


def test_toxic_documents_of_the_held_out_fold_are_found(spark):
    rng = random.Random(12)
    calm = [f"calm{i}" for i in range(400)]
    mean = [f"rude{c}" for c in "abcdefghij"]

    def text(toxic):
        w = [rng.choice(calm) for _ in range(rng.choice([12, 40, 120]))]
        for _ in range(4 if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(mean) + rng.choice(["", ",", "!"]))
        return " ".join(w)

    marks = [int(rng.random() < 0.2) for _ in range(700)]
    rows = [(i, text(m)) for i, m in enumerate(marks)] + [(800, None), (801, ""), (None, "calm1 calm2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks)] + [(0, marks[0]), (650, None), (5000, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.scores(docs, labels).collect()}
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    for i in (*range(700), 800, 801):
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [i for i in range(700) if out[i].held_out]
    hit = [out[i].predicted for i in held if marks[i]]
    false = [out[i].predicted for i in held if not marks[i]]
    assert sum(hit) >= 0.9 * len(hit) and sum(false) <= 0.03 * len(false)
    named = docs.selectExpr("*", "1 as _score", "'x' as _features", "2 as label")
    clean = toxicity.drop_toxic(named, labels)
    assert clean.columns == named.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, r in out.items() if not r.predicted}


def test_without_labels_of_both_kinds_the_share_is_the_score(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.scores(docs, none).collect()} == {0.0}
    ones = spark.createDataFrame([(i, 1) for i in range(10)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.scores(docs, ones).collect()} == {1.0}
    assert toxicity.scores(docs.where("false"), none).count() == 0
