"""Final conversations from event logs, rendered for training with a loss mask.

A log holds events of conversations: a message is opened, streamed in deltas, edited, generated anew. Events are dealt by
(conversation, message) and sorted by sequence number; one pass with the state of one message folds them. A long
conversation thus spreads over all tasks and no task holds more than one message. The rendered form is one segment per
message, in order; a conversation's training text is its segments one after the other.

Event kinds, by ``kind``: ``message`` opens a message with a role and perhaps text; ``delta`` appends text; ``edit``
replaces the text; ``regenerate`` discards it and starts again with the text given. A message keeps the place of its first
event and the last role named. Unknown kinds are an error. Null text is empty, a null role is empty, a null sequence number
comes first, a null conversation id is a conversation of its own. Events with equal sequence numbers are folded in the order
of kind (message, regenerate, edit, delta) and text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .common import ship

# Strings that mark turns, in this template and in common others. None may stand unescaped inside a text.
TURN, TEXT_AT, END = "<|im_start|>", "\n", "<|im_end|>\n"
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile(r"(\\*)(" + "|".join(map(re.escape, CONTROLS)) + ")")
_ESCAPED = re.compile(r"(\\+)(" + "|".join(map(re.escape, CONTROLS)) + ")")
_RANK = {"message": 0, "regenerate": 1, "edit": 2, "delta": 3}


def escape(text: str) -> str:
    """Backslashes before a control string are doubled and one is added, so no control string stands bare."""
    return _CONTROL.sub(lambda m: "\\" * (2 * len(m[1]) + 1) + m[2], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" * (len(m[1]) // 2) + m[2], text)


def escape_role(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def render_turn(role: str, text: str, learn: bool) -> tuple[str, int, int]:
    """The segment of a turn and the span of it that counts for the loss (empty where nothing is learned).

    A text that ends in backslashes gets them doubled, lest they escape the mark behind it.
    """
    tail = len(text) - len(text.rstrip("\\"))
    head = f"{TURN}{escape_role(role)}{TEXT_AT}"
    body = escape(text) + "\\" * tail
    return head + body + END, len(head) if learn else 0, len(head) + len(body) if learn else 0


def parse_turn(segment: str) -> tuple[str, str]:
    """Role and text of a segment, the exact inverse of ``render_turn``."""
    if not (segment.startswith(TURN) and segment.endswith(END)):
        raise ValueError("not a turn")
    role, _, body = segment[len(TURN): -len(END)].partition(TEXT_AT)
    return unescape_role(role), body_text(body)


def body_text(body: str) -> str:
    tail = len(body) - len(body.rstrip("\\"))
    return unescape(body[: len(body) - tail // 2] if tail else body)


_FOLDED = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("msg", pa.string()), ("role", pa.string()), ("text", pa.string())])


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, seq, msg, role, text) of every final message from (conv_id, msg, seq, kind, role, text) events."""
    ship(events.sparkSession)
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(r)) for k, r in _RANK.items()],
                      F.raise_error(F.concat(F.lit("unknown event kind "), F.coalesce("kind", F.lit("null")))).cast("int"))
    log = events.select("conv_id", "msg", "seq", rank.alias("rank"), "role",
                        F.coalesce("text", F.lit("")).alias("text"))
    log = log.repartition("conv_id", "msg").sortWithinPartitions("conv_id", "msg", "seq", "rank", "text")

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, role, seq, parts, done = None, None, None, [], []
        held = 0

        def close() -> None:
            done.append((now[0], seq, now[1], role or "", "".join(parts)))

        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "msg", "seq", "rank", "role", "text")]
            for conv, msg, s, kind, r, text in zip(*cols):
                if now != (conv, msg):
                    if now is not None:
                        close()
                        held += sum(map(len, parts))
                    now, role, seq, parts = (conv, msg), None, s, []
                role = r if r is not None else role
                if kind in (1, 2):  # generated anew or edited: what was said is gone
                    parts = [text]
                else:
                    parts.append(text)
                if held > 8_000_000:
                    yield _columns(done, _FOLDED)
                    done, held = [], 0
        if now is not None:
            close()
        if done:
            yield _columns(done, _FOLDED)

    return log.mapInArrow(fold, "conv_id bigint, seq bigint, msg string, role string, text string")


def render(messages: DataFrame, learn_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Add to every message its ``segment`` and the span (``loss_start``, ``loss_end``) under the loss mask, in code points."""
    ship(messages.sparkSession)
    kept = [c for c in messages.columns if c not in ("segment", "loss_start", "loss_end")]
    base = messages.select(*kept)
    schema = T.StructType([*base.schema.fields, T.StructField("segment", T.StringType()), T.StructField("loss_start", T.LongType()),
                           T.StructField("loss_end", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles = b.column(b.schema.get_field_index("role")).to_pylist()
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            out = [render_turn(r or "", t or "", r in learn_roles) for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.int64())], names=[*b.schema.names, "segment", "loss_start", "loss_end"])

    return base.mapInArrow(run, schema)


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation what can be read back from its segments: turns, their digest, the text under the loss mask.

    Segments stream through in order; a digest of a whole conversation has to pass them one by one, in constant memory.
    """
    ship(rendered.sparkSession)
    s = rendered.select("conv_id", "seq", "msg", "segment", "loss_start", "loss_end")
    s = s.repartition("conv_id").sortWithinPartitions("conv_id", "seq", "msg")
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, state, done = False, None, None, []

        def close() -> None:
            n, turns, loss_n, loss, chars = state
            done.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "segment", "loss_start", "loss_end")]
            for c, segment, start, end in zip(*cols):
                if not started or c != conv:
                    if started:
                        close()
                    started, conv, state = True, c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_turn(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if end > start:
                    learned = body_text(segment[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(segment)
            if len(done) > 10_000:
                yield _columns(done, _DIGESTS)
                done = []
        if started:
            close()
        if done:
            yield _columns(done, _DIGESTS)

    return s.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


#: code points of one streamed delta where a log is made from finished messages
DELTA_CHARS = 512


def as_events(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as the log that would have streamed them.

    Rows that share conversation and turn are messages of their own, in the order of role and text.
    """
    nth = F.row_number().over(W.partitionBy("conv_id", "turn").orderBy("role", "text"))
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn("_nth", nth)
    msg = F.format_string("%s/%010d", F.coalesce(F.col("turn").cast("string"), F.lit("-")), "_nth")
    # one pass cuts a text into its deltas; taking each by its position would read the text anew for every one of them
    pieces = F.concat(F.array(F.lit("")), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0)))
    events = rows.withColumn("msg", msg).select("conv_id", "turn", "role", "msg", F.posexplode(pieces).alias("_step", "_piece"))
    opening = F.col("_step") == 0
    # the position of an event: its turn, then its step; a text of 2 GB has fewer steps than that
    seq = F.coalesce(F.col("turn"), F.lit(-(1 << 42))) * (1 << 20) + F.col("_step")
    return events.select("conv_id", "msg", seq.cast("bigint").alias("seq"), F.when(opening, "message").otherwise("delta").alias("kind"),
                         F.when(opening, F.col("role")).alias("role"), F.col("_piece").alias("text"))
