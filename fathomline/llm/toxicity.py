"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

A lexicon is learned from labelled documents: normalised words and their beginnings (``PREFIXES`` letters), counted over toxic and
clean documents, and kept where the log-likelihood ratio and the odds speak for toxic. Per document, 18 dense features: densities and
weights of lexicon hits, hits near second-person words, capitals, punctuation, digits, obfuscation. A labelled document is
described with its own share taken out of the lexicon's counts, so the trees do not learn from a lexicon that has already
seen the answer. The trees are fitted on four fifths of the training rows, the isotonic curve on the rest.

Only training uses labels. It takes at most about ``max_rows`` labelled rows, chosen by a hash of their id; all documents are scored, on
their whole texts. The model is a few thousand numbers and at most ``LEXICON`` terms, whatever the corpus.

Defined cases: a null or empty text has all features 0 and gets a score like any other. Labels that are null or neither 0 nor 1 are left
out; of several labels of one id the largest counts. Without labels of both kinds all scores are the share of toxic labels (0
without any). An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut_lineage
from .common import fresh, ship
from .wordhash import text_chunks

#: labelled rows that a model is fitted on, about; terms of the lexicon at most; letters of word beginnings
MAX_ROWS, LEXICON, PREFIXES = 12_000, 20_000, (4, 5)
#: least log-likelihood ratio and log-odds of a term
MIN_LLR, MIN_LOD, STRONG_LOD = 20.0, 1.0, 2.5
#: words between a lexicon hit and a second-person word that still count as near
NEAR = 5
FOLDS = 5
N_FEATURES = 18
#: share of the uncalibrated score in the final one; it orders what the isotonic curve ties
TIE_BREAK = 1e-3

# Second-person words of the four languages, and look-alikes of letters.
SECOND_PERSON = frozenset("you your yours u ur yourself tu te toi vous votre vos ton ta tes du dich dir dein deine deinen euch euer ihr tú ti usted ustedes vosotros tus".split())
LOOK_ALIKE = str.maketrans("013457@$!|€", "oieastasiie")
_LETTERS = re.compile(r"[\W\d_]+")
_RUN = re.compile(r"(.)\1{2,}")


def normal_form(word: str) -> tuple[str, bool]:
    """A word in lower case without look-alikes, marks and drawn-out letters, and whether that took more than trimming."""
    low = word.lower()
    if low.isalpha():
        plain = _RUN.sub(r"\1", low)
        return plain, plain != low
    core = low.strip(".,;:!?\"'()[]{}<>*#%&$~-_/\\|")
    if core.isalpha():
        plain = _RUN.sub(r"\1", core)
        return plain, plain != core
    if not any(c.isalpha() for c in core):
        return "", False
    plain = _RUN.sub(r"\1", _LETTERS.sub("", core.translate(LOOK_ALIKE)))
    return plain, True


def terms_of(form: str) -> list[str]:
    """The lexicon terms of a normalised word: itself, and its beginnings marked as such."""
    return [form, *(form[:k] + "*" for k in PREFIXES if len(form) > k)] if form else []


def log_odds(a: float, b: float, toxic: int, clean: int) -> float:
    return math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))


def likelihood_ratio(a: float, b: float, toxic: int, clean: int) -> float:
    """How unlikely ``a`` toxic and ``b`` clean documents are for a term that says nothing."""
    n, share = a + b, toxic / max(toxic + clean, 1)
    if not 0 < share < 1 or a <= n * share:
        return 0.0
    return 2 * (a * math.log(a / (n * share)) + (b * math.log(b / (n * (1 - share))) if b else 0.0))


@dataclass
class Lexicon:
    counts: dict[str, tuple[int, int]]
    toxic: int
    clean: int
    weights: dict[str, float] = field(default_factory=dict)

    def without(self, label: int | None) -> dict[str, float]:
        """Weights of the terms, as a document of this label that was counted sees them; None for any other document."""
        out = {}
        for term, (a, b) in self.counts.items():
            a, b = a - (label == 1), max(b - (label == 0), 0)
            t, c = self.toxic - (label == 1), self.clean - (label == 0)
            if a > 0 and likelihood_ratio(a, b, t, c) >= MIN_LLR and (w := log_odds(a, b, t, c)) >= MIN_LOD:
                out[term] = w
        return out


_UPPER, _DIGIT, _PUNCT, _BANG = (np.zeros(256, dtype=np.int64) for _ in range(4))
_UPPER[65:91] = 1
_DIGIT[48:58] = 1
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_BANG[[33, 63]] = 1


class Describer:
    """Features of texts under one set of term weights. Distinct words are judged once and remembered, within a bound that
    keeps a worker's memory small; most words have nothing to them and share one judgement."""

    REMEMBERED = 200_000
    NOTHING = (0.0, 0.0, 0, 0, 0)

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.seen: dict[str, tuple[float, float, int, int, int]] = {}

    def _judge(self, word: str) -> tuple[float, float, int, int, int]:
        """Weight as a word, weight by its beginnings, whether obfuscated, all capitals, second person."""
        form, odd = normal_form(word)
        whole, *starts = terms_of(form) or [""]
        w = self.weights.get(whole, 0.0)
        p = max((self.weights.get(s, 0.0) for s in starts), default=0.0)
        found = (w, p, int(odd), int(len(word) > 2 and word.isupper()), int(form in SECOND_PERSON))
        return found if any(found) else self.NOTHING

    def features(self, texts: pa.Array) -> np.ndarray:
        texts = pc.fill_null(texts.cast(pa.string()), "")
        out = np.zeros((len(texts), N_FEATURES))
        lists = pc.ascii_split_whitespace(pc.utf8_trim_whitespace(texts))
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.seen) > self.REMEMBERED:
            self.seen.clear()
        for w in distinct:
            if w not in self.seen:
                self.seen[w] = self._judge(w)
        info = np.array([self.seen[w] for w in distinct], dtype=np.float64).reshape(len(distinct), 5)
        code = words.indices.to_numpy()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        n = np.diff(bounds)
        doc = np.repeat(np.arange(len(n)), n)
        per = info[code]
        filled = np.array([bool(w) for w in distinct], dtype=bool)[code] if len(distinct) else np.zeros(0, bool)
        count = np.bincount(doc, weights=filled, minlength=len(n))
        some = np.maximum(count, 1)

        def total(x: np.ndarray) -> np.ndarray:
            return np.bincount(doc, weights=x, minlength=len(n))

        best = np.maximum(per[:, 0], per[:, 1]) if len(per) else np.zeros(0)
        strong = best >= STRONG_LOD
        near = np.zeros(len(best), bool)
        second = np.flatnonzero(per[:, 4] > 0) if len(per) else np.zeros(0, dtype=np.int64)
        hits = np.flatnonzero(strong)
        if len(second) and len(hits):
            right = np.searchsorted(second, hits)
            for at in (np.minimum(right, len(second) - 1), np.maximum(right - 1, 0)):
                near[hits] |= (np.abs(second[at] - hits) <= NEAR) & (doc[second[at]] == doc[hits])
        pairs = np.unique(np.stack([doc[hits], code[hits]]), axis=1)[0] if len(hits) else np.zeros(0, dtype=np.int64)
        high = np.zeros(len(n))
        np.maximum.at(high, doc, best)
        s = total(strong)
        out[:, 0] = total(per[:, 0] >= STRONG_LOD) / some if len(per) else 0
        out[:, 1] = total(per[:, 1] >= STRONG_LOD) / some if len(per) else 0
        out[:, 2] = total(best > 0) / some
        out[:, 3] = total(best) / some
        out[:, 4] = high
        out[:, 5] = np.log1p(s)
        out[:, 6] = np.log1p(np.bincount(pairs, minlength=len(n)))
        out[:, 7] = total(per[:, 4]) / some if len(per) else 0
        out[:, 8] = total(near) / some
        out[:, 9] = np.log1p(total(near))
        out[:, 10] = total(per[:, 3]) / some if len(per) else 0
        out[:, 11] = total(per[:, 2]) / some if len(per) else 0
        for first, data, at in text_chunks(texts):
            size = np.maximum(np.diff(at), 1)
            rows = slice(first, first + len(size))
            for k, table in ((12, _UPPER), (13, _DIGIT), (14, _PUNCT), (15, _BANG)):
                sums = np.concatenate(([0], np.cumsum(table[data])))
                out[rows, k] = (sums[at[1:]] - sums[at[:-1]]) / size
            out[rows, 16] = size / np.maximum(count[rows], 1)
        out[:, 17] = np.log1p(count)
        out[count == 0] = 0
        return out


_describers: dict[int, Describer] = {}


def features(text: Column, weights: dict[str, float]) -> Column:
    """A column of dense features. A Python worker keeps the judged words of the last model it used."""
    key = hash(tuple(sorted(weights.items())))

    @F.pandas_udf("array<double>")
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _describers:
            _describers.clear()
            _describers[key] = Describer(weights)
        d = _describers[key]
        for texts in batches:
            found = [d.features(pa.array(texts.iloc[lo: lo + 1000], pa.string(), from_pandas=True)) for lo in range(0, len(texts), 1000)]
            yield pd.Series(list(np.concatenate(found)) if found else [], dtype=object)

    return describe(text)


# -------------------------------------------------------------------------------------------------------------- training
def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: one in ``FOLDS``, by a checksum of its id as text."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    trees: Model | None
    curve: Model | None
    base: float

    def score(self, docs: DataFrame, text_col: str, out: str) -> DataFrame:
        """``docs`` with the score added as the column ``out``."""
        if self.trees is None:
            return docs.withColumn(out, F.lit(self.base))
        x, raw, prob, label, p, fitted = fresh(docs, "_features", "_raw", "_probability", "_prediction", "_p", "_fitted")
        described = docs.withColumn(x, array_to_vector(features(F.col(text_col), self.weights)))
        trees = self.trees.copy()
        for setter, name in (("setFeaturesCol", x), ("setRawPredictionCol", raw), ("setProbabilityCol", prob), ("setPredictionCol", label)):
            getattr(trees, setter)(name)
        scored = trees.transform(described).withColumn(p, vector_to_array(prob)[1])
        value = F.col(p)
        if self.curve is not None:
            curve = self.curve.copy().setFeaturesCol(p).setPredictionCol(fitted)
            scored = curve.transform(scored)
            value = F.col(fitted) * (1 - TIE_BREAK) + F.col(p) * TIE_BREAK
        return scored.withColumn(out, F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0))).select(*docs.columns, out)


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many toxic and clean documents each term stands. Terms of toxic documents only, others cannot qualify."""
    toxic: dict[str, int] = {}
    clean: dict[str, int] = {}
    for b in batches:
        for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found: set[str] = set()
            for word in set((text or "").split()):
                found.update(terms_of(normal_form(word)[0]))
            into = toxic if label else clean
            for t in found:
                into[t] = into.get(t, 0) + 1
    keys = list(toxic.keys() | clean.keys())
    for lo in range(0, len(keys), 50_000):
        some = keys[lo: lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([toxic.get(k, 0) for k in some], pa.int64()),
                                          pa.array([clean.get(k, 0) for k in some], pa.int64())], names=["term", "a", "b"])


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(id, text, label) of about ``max_rows`` labelled documents outside the held-out fold, chosen by a hash of the id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(
        F.col(id_col).cast("bigint").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    share = min(1.0, max_rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit(41)), F.lit(1 << 24)) < math.ceil(share * (1 << 24)))
    own = docs.select(F.col(id_col).cast("bigint").alias("_own"), F.col(text_col).alias("text"))
    # about max_rows ids of 12 bytes: small by construction
    return own.join(F.broadcast(chosen), F.col("_own") == F.col("id")).select("id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> ToxicityModel:
    spark = docs.sparkSession
    ship(spark)
    rows = cut_lineage(training_rows(docs, labels, max_rows, id_col, text_col, label_col), "train")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    base = toxic / (toxic + clean) if toxic + clean else 0.0
    if not toxic or not clean:
        return ToxicityModel({}, None, None, base)
    counted = rows.select("text", "label").mapInArrow(_count_terms, "term string, a bigint, b bigint").groupBy("term").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    share = toxic / (toxic + clean)
    total = F.col("a") + F.col("b")
    llr = 2 * (F.col("a") * F.log(F.col("a") / (total * share)) + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / (total * (1 - share)))).otherwise(0.0))
    best = counted.where((F.col("a") > total * share) & (llr >= MIN_LLR)).orderBy(llr.desc(), "term").limit(LEXICON).collect()
    lexicon = Lexicon({r["term"]: (int(r["a"]), int(r["b"])) for r in best}, toxic, clean)

    described = [rows.where(F.col("label") == y).withColumn("x", features(F.col("text"), lexicon.without(y))) for y in (0, 1)]
    part = F.pmod(F.xxhash64("id", F.lit(43)), F.lit(5))
    table = cut_lineage(described[0].unionByName(described[1]).select(
        "id", F.col("label").cast("double").alias("label"), "x", (part == 0).alias("calibrate")), "features")
    table = table.withColumn("features", array_to_vector("x")).repartition(4, "id").sortWithinPartitions("id")
    trees = GBTClassifier(maxIter=25, maxDepth=3, stepSize=0.2, minInstancesPerNode=2, seed=7).fit(table.where("not calibrate"))
    curve_rows = trees.transform(table.where("calibrate")).withColumn("p", vector_to_array("probability")[1])
    kinds = curve_rows.select("label").distinct().count()
    curve = IsotonicRegression(featuresCol="p", predictionCol="fitted").fit(curve_rows.select("label", "p")) if kinds == 2 else None
    return ToxicityModel(lexicon.without(None), trees, curve, base)


def scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(slim, labels.withColumnRenamed(id_col, "doc_id"), **options)
    done = model.score(slim, "text", "score")
    return done.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that score below one half, with all their columns."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col, **options)
    score, = fresh(docs, "_score")
    return model.score(docs, text_col, score).where(F.col(score) < 0.5).select(*docs.columns)
