"""Packing of tokenised documents into sequences of fixed length, every sequence mixed from the sources in target proportion.

Each source is a queue of its documents' tokens, in the order of document id. Deficit round-robin serves the queues window
by window: a source's quantum is its target share of the window, what rounding withholds stays as its deficit and is served
in a later window. Because a source's credit after any number of windows is its share of all tokens served, the allocation
up to window w has a closed form: with the sources in a row, the first s of them have had ``floor(share of the first s * w *
length)`` tokens together. Every window is full, no deficit ever exceeds one token, and each partition computes its windows
from token positions alone, whatever other partitions do: deficits carry over window and partition borders by arithmetic.

Targets are the sources' shares of the tokens that are left, so all queues end together and nothing is left over. With given
``weights`` the sources share each window by weight as long as they last; when one runs dry, the rest share its part. These
changes of the mix are the phases; within a phase the closed form holds. All tokens are packed, all sequences but the last are
full.

Defined cases: a null text is empty and gives the end token alone. A null source is a source of its own, the first. Rows that
repeat an id are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..runtime import cut_lineage
from .common import arrow_schema, fresh, running_sum, ship

LENGTH = 4096
#: words whose token ids a Python worker remembers; beyond it the memory is emptied, which costs time only
WORDS_REMEMBERED = 1_000_000
#: bytes of text tokenised together
TEXT_AT_ONCE = 16 << 20
TOKEN = np.dtype("<u4")


#: a word that is letters with marks behind them: two units for the tokenizer, if it has no apostrophe
_MARKED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")


class WordTokenizer:
    """Token ids of texts, word by word, with a memory of the words seen.

    Only for tokenizers that never join across white space, as those do that drop it, and that end a word's last piece with
    ``</w>``: a text's ids are then those of its words in a row. The distinct words of many texts are looked up once;
    new words of plain letters are encoded together, by the same model without the steps that leave such words alone.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.seen: dict[str, bytes] = {"": b""}
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)
        for piece, i in self.tok.get_vocab().items():
            self.ends[i] = piece.endswith("</w>")

    def _one(self, word: str) -> bytes:
        return np.array(self.tok.encode(word, add_special_tokens=False).ids, dtype=TOKEN).tobytes()

    @staticmethod
    def _plain(word: str) -> bool:
        """Letters below U+0100 only: one unit of the tokenizer, lower-cased letter by letter."""
        return word.isalpha() and (word.isascii() or max(word) < "\u0100")

    def _learn(self, words: list[str]) -> None:
        seen, parts = self.seen, {}
        for w in words:
            if self._plain(w):
                parts[w] = (w.lower(), "")
            elif (m := _MARKED.fullmatch(w)) and self._plain(m[1]) and not m[2].startswith(("<|", "|>")) and "<|" not in m[2]:
                parts[w] = (m[1].lower(), m[2])
            else:
                seen[w] = self._one(w)
        for mark in {m for _, m in parts.values()}:
            if mark not in seen:
                seen[mark] = self._one(mark)
        new = [w for w in {c for c, _ in parts.values()} if w not in seen]
        for lo in range(0, len(new), 500):
            some = new[lo: lo + 500]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype=TOKEN)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):  # a letter that the tokenizer takes apart
                seen.update((w, self._one(w)) for w in some)
                continue
            raw, start = ids.tobytes(), 0
            for w, stop in zip(some, (stops * TOKEN.itemsize).tolist()):
                seen[w] = raw[start:stop]
                start = stop
        for w, (core, mark) in parts.items():
            seen[w] = seen[core] + seen[mark]

    def encode_column(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each closed by ``end``, and the positions at which texts begin (and the last ends)."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [w for w in distinct if w not in self.seen]
        if len(self.seen) + len(new) > WORDS_REMEMBERED:
            self.seen.clear()
            self.seen[""] = b""
            new = [w for w in distinct if w]
        self._learn(new)
        blobs = [self.seen[w] for w in distinct]
        flat = np.frombuffer(b"".join(blobs), dtype=TOKEN)
        sizes = np.fromiter(map(len, blobs), dtype=np.int64, count=len(blobs)) // TOKEN.itemsize
        begins = np.cumsum(sizes) - sizes
        code = words.indices.to_numpy()
        n = sizes[code]
        ends = np.cumsum(n)
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        at = np.concatenate(([0], ends))[bounds]
        ids = flat[np.repeat(begins[code] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        if end is not None:
            k = len(bounds) - 1
            out = np.full(len(ids) + k, end, dtype=TOKEN)
            out[np.arange(len(ids)) + np.repeat(np.arange(k), np.diff(at))] = ids
            ids, at = out, at + np.arange(k + 1)
        return ids, at

    def encode(self, texts: list[str | None]) -> list[bytes]:
        ids, at = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def _chars(texts: pa.Array) -> int:
    return pc.sum(pc.binary_length(texts)).as_py() or 0


def tokenise(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, n_tokens, ids) of every document; ids are little-endian unsigned 32-bit numbers, the end id last."""
    ship(docs.sparkSession)
    schema = arrow_schema(doc_id=pa.int64(), source=pa.string(), n_tokens=pa.int64(), ids=pa.binary())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                n = 8000
                while n > 1 and _chars(b.column(2).slice(lo, n)) > TEXT_AT_ONCE:
                    n //= 2
                part = b.slice(lo, n)
                ids, at = tok.encode_column(part.column(2), end_id)
                data = pa.BinaryArray.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((at * 4).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(at)), data], schema=schema)
                lo += n

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, source string, n_tokens bigint, ids binary")


# ------------------------------------------------------------------------------------------------------------ allocation
class Phases:
    """The whole allocation, from the sources' token counts: who is served where.

    Sources are numbered in queue order. A phase is (first token served in it, tokens it serves, per source the running sum of
    shares and the tokens served before). Few numbers per source; the only state that tasks need.
    """

    def __init__(self, counts: list[int], weights: list[int] | None = None):
        left = list(counts)
        n = len(counts)
        self.phases: list[tuple[int, int, list[int], int, list[int]]] = []
        start, served = 0, [0] * n
        while any(left):
            w = [(left[i] if weights is None else weights[i]) if left[i] else 0 for i in range(n)]
            if not any(w):  # only sources of weight zero are left
                w = left[:]
            total = sum(w)
            # served until the first source of this phase runs dry
            lasts = min(Fraction(left[i] * total, w[i]) for i in range(n) if w[i])
            length = max(1, int(lasts))
            cum = np.cumsum([0, *w]).tolist()
            marks = [length * c // total for c in cum]
            got = [marks[i + 1] - marks[i] for i in range(n)]
            over = [max(0, got[i] - left[i]) for i in range(n)]
            if any(over):  # rounding would serve a token that is not there: serve whole tokens one source at a time
                i = next(i for i in range(n) if left[i] and w[i])
                w = [int(j == i) for j in range(n)]
                total, length = 1, 1
                cum = np.cumsum([0, *w]).tolist()
                got = w[:]
            self.phases.append((start, length, cum, total, served[:]))
            served = [a + b for a, b in zip(served, got)]
            left = [a - b for a, b in zip(left, got)]
            start += length

    def pieces(self, source: int, first: int, n: int, length: int) -> list[tuple[int, int, int, int]]:
        """(sequence, offset, first token, tokens) of tokens ``first .. first + n`` of a source's queue."""
        out = []
        for start, size, cum, total, served in self.phases:
            lo, hi = cum[source], cum[source + 1]
            had = served[source]
            if hi == lo:
                continue
            gets = size * hi // total - size * lo // total
            a, b = max(first, had), min(first + n, had + gets)
            if a >= b:
                continue
            # windows of the phase by the sequence border they end at
            def given(t: int) -> int:
                """Tokens of this source among the first ``t`` served in the phase."""
                return t * hi // total - t * lo // total

            w = self._window_of(a - had, given, start, size, length)
            while a < b:
                begin = max(0, w * length - start)
                end = min(size, (w + 1) * length - start)
                g0, g1 = given(begin), given(end)
                take = min(b, had + g1) - a
                if take > 0:
                    # in the window: what all phases before put there, then the sources in order
                    before = (begin + start - w * length) + (end * lo // total - begin * lo // total)
                    out.append((w, before + (a - had - g0), a, take))
                    a += take
                w += 1
        return out

    @staticmethod
    def _window_of(token: int, given, start: int, size: int, length: int) -> int:
        """The window in which a source's token of this phase is served, by bisection."""
        lo, hi = start // length, (start + size - 1) // length
        while lo < hi:
            mid = (lo + hi) // 2
            if given(min(size, (mid + 1) * length - start)) > token:
                hi = mid
            else:
                lo = mid + 1
        return lo


def pack(tokens: DataFrame, length: int = LENGTH, weights: Mapping[str | None, int] | None = None) -> DataFrame:
    """The pieces of all documents of ``tokens`` (doc_id, source, n_tokens, ids): one row per piece, with its ids.

    (doc_id, source, start, length, ids, doc_tokens, sequence_id, offset). ``tokens`` should be a written table, it is read
    twice.
    """
    spark = tokens.sparkSession
    ship(spark)
    # copies of an id are told apart by their content; copies of the whole row are interchangeable
    sized = tokens.select("doc_id", "source", "n_tokens", F.xxhash64("ids").alias("mark"))
    placed = running_sum(sized, ["source", "doc_id", "mark"], "n_tokens", "before")
    counts = tokens.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()  # one row per source
    order = sorted(counts, key=lambda r: (r["source"] is not None, (r["source"] or "").encode()))
    names = {r["source"]: i for i, r in enumerate(order)}
    bases = np.cumsum([0, *[int(r["n"]) for r in order]]).tolist()
    share = None if weights is None else [int(weights.get(r["source"], 0)) for r in order]
    phases = Phases([int(r["n"]) for r in order], share)
    schema = arrow_schema(doc_id=pa.int64(), source=pa.string(), start=pa.int64(), length=pa.int64(), ids=pa.binary(),
                          doc_tokens=pa.int64(), sequence_id=pa.int64(), offset=pa.int64())

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, sources, n, at, data = (b.column(i).to_pylist() for i in range(5))
            rows = []
            for doc, source, size, before, ids in zip(docs, sources, n, at, data):
                s = names[source]
                first = before - bases[s]
                for seq, offset, token, take in phases.pieces(s, first, size, length):
                    start = token - first
                    rows.append((doc, source, start, take, ids[4 * start: 4 * (start + take)], size, seq, offset))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)] if rows else
                                             [pa.array([], f.type) for f in schema], schema=schema)

    # equal rows pair off by their rank among their equals, which is 0 but for rows repeated whole
    k, = fresh(placed, "_copy")
    w = W.partitionBy("source", "doc_id", "mark").orderBy("n_tokens")
    dup = placed.groupBy("source", "doc_id", "mark").count().where("count > 1").limit(1).count()
    left = tokens.withColumn("mark", F.xxhash64("ids"))
    if dup:
        left = left.withColumn(k, F.row_number().over(w))
        placed = placed.withColumn(k, F.row_number().over(w))
    else:
        left, placed = left.withColumn(k, F.lit(1)), placed.withColumn(k, F.lit(1))
    right = placed.select(F.col("source").alias("_s"), F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.col(k).alias("_k"), "before")
    both = left.join(right, left["doc_id"].eqNullSafe(right["_d"]) & (left["mark"] == right["_m"]) & left["source"].eqNullSafe(right["_s"])
                     & (left[k] == right["_k"]))
    return both.select("doc_id", "source", "n_tokens", "before", "ids").mapInArrow(
        cut, "doc_id bigint, source string, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def with_crc(pieces: DataFrame) -> DataFrame:
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens, padded) - the packed sequences; a sequence holds at most ``length`` tokens.

    A sequence is padded to ``length`` unless its number of tokens is a power of two.
    """
    n = F.sum("length").alias("n_tokens")
    grouped = pieces.groupBy("sequence_id").agg(n, F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    ids = F.aggregate("_p", F.lit(b""), lambda a, p: F.concat(a, p.ids))
    power = F.bit_count("n_tokens") == 1
    pad = F.when(power, F.lit(0)).otherwise(F.greatest(F.lit(length) - F.col("n_tokens"), F.lit(0)))
    zero = F.unhex(F.repeat(F.hex(F.lit(np.array([pad_id], TOKEN).tobytes())), pad.cast("int")))
    return grouped.select("sequence_id", F.concat(ids, zero).alias("ids"), "n_tokens", pad.cast("bigint").alias("padded"))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = LENGTH, weights: Mapping[str | None, int] | None = None,
                   source_col: str = "source") -> DataFrame:
    """Tokenise and pack ``docs`` (doc_id, text, source). The token table is written once and read by all later steps."""
    return pack(cut_lineage(tokenise(docs, tokenizer_path, end_id, source_col=source_col), "tokens"), length, weights)
