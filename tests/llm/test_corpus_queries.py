"""The registered corpus queries against their SQL, and the pipeline against its contract."""

import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_texts import plain_groups
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from fathomline.llm import mixing, queries, toxicity  # noqa: E402
from tools.compare import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    rows, _, message = compare(spark, connect(FOLDER), name, FOLDER)
    assert message is None and rows > 0


def test_every_operator_has_its_query():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names


def test_pipeline_stages_keep_the_columns_and_drop_what_they_should(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    extra = docs.selectExpr("*", "doc_id as rep", "'k' as _copy", "1.5 as score").unionByName(
        docs.limit(1).selectExpr("cast(null as long) as doc_id", "cast(null as string) as text", "lang", "cast(null as string) as source", "n_chars",
                                 "0L as rep", "'k' as _copy", "0.5 as score"))
    before = extra
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.cut_lineage(stage(spark, before, FOLDER), "t")
        assert after.columns == extra.columns, name
        assert after.count() > 0
        before = after
    texts = [r.text for r in before.select("text").collect()]
    packed = corpus_pipeline.pack(spark, before, FOLDER)
    con = duckdb.connect()
    pieces = packed.toPandas()
    con.register("pieces", pieces)
    assert con.execute("select count(*) from (select sequence_id, sum(length) n, max(\"offset\" + length) m from pieces group by 1) where n <> m or n > 4096").fetchone()[0] == 0
    assert pieces.doc_id.nunique() <= len(texts)


def plain_mix(rows, weight, drawn):
    """(id, text, source) as often as taken, by taking documents one after another in the order of their keys."""
    words = {i: [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for i, t, _ in rows}
    by_source = defaultdict(list)
    for i, t, source in rows:
        by_source[source].append((-np.log(drawn[i]) / weight.get(i, 1.0), i, t))
    sizes = {s: sum(len(words[i]) for _, i, _ in ds) for s, ds in by_source.items()}
    asked = mixing.targets(sizes)
    out = []
    for source, ds in by_source.items():
        epochs, left = divmod(round(asked[source]), sizes[source] or 1)
        for _, i, t in sorted(ds, key=lambda d: d[0]):
            n = min(left, len(words[i]))
            left -= n
            if words[i]:
                out += [(i, t, source)] * (epochs + (n == len(words[i])))
                if 0 < n < len(words[i]):
                    out.append((i, " ".join(words[i][:n]), source))
    return out


def test_every_stage_of_a_run_keeps_what_plain_versions_keep(spark, tmp_path, monkeypatch):
    given, labels = (corpus_pipeline.table(spark, FOLDER, n) for n in ("documents", "labels"))
    rows = [tuple(r) for r in given.collect()]
    long = [r for r in rows if len(r[1].split()) > 80][:12]
    toxic = [r for r in rows if r[0] in {x.doc_id for x in labels.where("toxic = 1").collect()}][:3]
    rows += [(9000 + k, "\n".join(r[1].split(" ")), *r[2:]) for k, r in enumerate(long[:4])]
    rows += [(9100 + k, r[1] + " one more", *r[2:]) for k, r in enumerate(long)]
    rows += [(9200 + k, "a first word " + r[1] + " one more", *r[2:]) for k, r in enumerate(long)]
    rows += [(9300 + k, r[1], *r[2:]) for k, r in enumerate(toxic)]
    rows += [(9400, None, "en", "web", 0), (9401, "", "en", None, 0), (9402, " ".join(f"n{k}" for k in range(90)), "en", None, 0)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, given.schema).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    stages, cut = {}, corpus_pipeline.cut_lineage

    def noted(df, name):
        stages[name] = cut(df, name)
        return stages[name]

    monkeypatch.setattr(corpus_pipeline, "cut_lineage", noted)
    packed = corpus_pipeline.run(spark, folder)
    assert list(stages) == [f"stage-{n}" for n, _ in corpus_pipeline.STAGES] and packed is stages["stage-packing"]
    got = {n.removeprefix("stage-"): Counter(map(tuple, df.collect())) for n, df in stages.items()}
    docs = corpus_pipeline.table(spark, folder, "documents")

    score = {r.doc_id: r.score for r in toxicity.scores(docs, corpus_pipeline.table(spark, folder, "labels")).collect()}
    want = Counter(r for r in rows if score[r[0]] < 0.5)
    assert got["toxicity"] == want and len(want) < len(rows)

    first = {}
    for r in want:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
        first[text] = min(first.get(text, r[0]), r[0])
    before, want = want, Counter(r for r in want if r[0] in set(first.values()))
    assert got["exact_dedup"] == want and len(want) < len(before)

    groups = plain_groups([r[:2] for r in want], 80, 5)
    before, want = want, Counter(r for r in want if groups[r[0]][1] == r[0])
    assert got["ngram_jaccard"] == want and len(want) < len(before)

    weight = {r.doc_id: 2.0 if r.quality == 1 else 0.5 for r in labels.collect() if r.quality in (0, 1)}
    key = F.shiftrightunsigned(F.xxhash64("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(17)), 11)
    drawn = {r[0]: (r[1] + 0.5) / 2.0 ** 53 for r in docs.select("doc_id", key).collect()}
    lang = {r[0]: r[2] for r in want}
    mixed = plain_mix([(r[0], r[1], r[3]) for r in want], weight, drawn)
    assert got["mixing"] == Counter((i, t, lang[i], s, len(t)) for i, t, s in mixed)

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids, times = {}, Counter()
    for i, t, s in mixed:
        whole = np.array([*plain.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
        ids.setdefault((i, s, len(whole)), whole)
        times[i, s, len(whole)] += 1
    pieces, covered, sequences = packed.collect(), {k: np.zeros(k[2], int) for k in ids}, defaultdict(list)
    for p in pieces:
        k = (p.doc_id, p.source, p.doc_tokens)
        part = slice(p.start, p.start + p.length)
        assert p.length > 0 and len(ids[k][part]) == p.length and p.ids_crc32 == zlib.crc32(ids[k][part].tobytes())
        covered[k][part] += 1
        sequences[p.sequence_id].append((p.offset, p.length))
    assert all((covered[k] == times[k]).all() for k in ids)
    total = sum(k[2] * n for k, n in times.items())
    assert sorted(sequences) == list(range(-(-total // 4096)))
    for s, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == min(4096, total - 4096 * s)
