"""Chat formatting into windows of a token budget."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fairlead.llm.common import shuffle_partitions, slices, stored

BUDGET = 2048
HISTORY = 512
# A conversation is cut into blocks of this many budgets, each formatted by one task.
BLOCK_BUDGETS = 32
CHUNK_BYTES = 4 << 20

# The control strings of the template.
START = "<|im_start|>"
END = "<|im_end|>"

_OPEN = re.compile(r"<(\\*)\|")
_OPENED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    """Adds one backslash inside every ``<|`` (and ``<\\|``, ...), so no control string is left."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _OPENED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> tuple[str, int]:
    """(a turn of the template, place of its text)."""
    head = f"{START}{_escape_role(role)}\n"
    return f"{head}{escape(text)}{END}\n", len(head)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a window, unescaped."""
    return [(_unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _plain(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; role and text never null."""
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _counted(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Adds the tokens of each rendered turn."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Tokenizer.from_file(tokenizer)
        encoder.encode_special_tokens = True
        for part in slices(batches, "text", CHUNK_BYTES):
            rendered = [render(r, t)[0] for r, t in zip(part["role"].to_pylist(), part["text"].to_pylist())]
            counts = [len(e.ids) for e in encoder.encode_batch(rendered, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [*[part[n] for n in part.schema.names], pa.array(counts, pa.int64())], [*part.schema.names, "tokens"]
            )

    return turns.mapInArrow(rows, "conv_id long, turn long, role string, text string, part int, tokens long")


_ORDER = ("turn", "role", "text")


def _placed(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Adds ``before``: the tokens of the conversation's earlier turns, and ``place``, their number.

    Range partitions split a long conversation; each sums its own part, and the sums of the
    parts before it, one row per conversation and partition, are added. Turns are tokenised
    after they have moved: finding the ranges reads them once more, but plain.
    """
    parts = shuffle_partitions(turns.sparkSession)
    moved = _plain(turns).repartitionByRange(parts, "conv_id", *_ORDER).withColumn("part", F.spark_partition_id())
    ranged = stored(_counted(moved, tokenizer), "chat-ranges")
    sums = ranged.groupBy("conv_id", "part").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("conv_id").alias("c"),
        F.col("part").alias("p"),
        F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t0"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n0"),
    )
    own = Window.partitionBy("conv_id", "part").orderBy(*_ORDER)
    inside = ranged.withColumns(
        {"t1": F.sum("tokens").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"), "n1": F.row_number().over(own) - 1}
    )
    joined = inside.join(offsets, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")))
    return joined.select(
        "conv_id", "role", "text", "tokens", (F.col("t0") + F.col("t1")).alias("before"), (F.col("n0") + F.col("n1")).alias("place")
    )


def format_conversations(
    turns: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """Windows of whole turns: conv_id, block, window, formatted, loss, repeated, n_turns, tokens.

    Prefix sums of the turns' tokens choose the spans: a window takes as many new turns as
    the budget leaves after what it repeats, at least one. It repeats a leading ``system``
    turn, and then the latest earlier turns of at most ``history`` tokens; ``repeated``
    counts these turns at its front. ``loss`` lists the places of the new assistant texts in
    ``formatted`` (code points, end exclusive); repeated turns are never among them.
    ``tokens`` exceeds the budget only where one turn alone does; the system turn is left out only
    of windows where it does not fit together with the first new turn.

    A conversation is cut into blocks of ``BLOCK_BUDGETS`` budgets, so no task holds a long
    one; the first window of a block repeats history from the block before.

    Turns go by ``turn``, then role and text; null turns come first; repeated rows are turns
    of their own. A null role or text is empty, rows without conv_id are one conversation,
    other columns are not read, and an empty table gives no rows. Control strings in texts
    and roles are escaped reversibly.
    """
    placed = stored(_placed(turns, tokenizer), "chat-turns")
    size = BLOCK_BUDGETS * budget
    block = F.expr(f"before div {size}")
    own = placed.withColumns({"block": block, "kind": F.lit(2)})
    tail = own.where(F.col("before") >= (F.col("block") + 1) * size - history).withColumns(
        {"block": F.col("block") + 1, "kind": F.lit(1)}
    )
    # History is copied only to blocks that exist, the system turn to every later block.
    later = own.where("block > 0").select(F.col("conv_id").alias("c"), F.col("block").alias("b")).distinct()
    tail = tail.join(later, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left_semi")
    system = own.where("place = 0 AND role = 'system'").drop("block", "kind")
    system = later.join(system, F.col("c").eqNullSafe(F.col("conv_id"))).withColumns({"block": F.col("b"), "kind": F.lit(0)})
    every = own.unionByName(tail).unionByName(system.select(*own.columns))
    dealt = every.repartition(shuffle_partitions(turns.sparkSession), "conv_id", "block").sortWithinPartitions(
        "conv_id", "block", "kind", "place"
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _windows(batches, budget, history)

    fields = "conv_id long, block long, window int, formatted string, loss array<struct<start:bigint,end:bigint>>"
    columns = ("conv_id", "block", "kind", "role", "text", "tokens")
    return dealt.select(*columns).mapInArrow(rows, f"{fields}, repeated int, n_turns int, tokens long")


def _windows(batches: Iterator[pa.RecordBatch], budget: int, history: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    current: tuple | None = None
    out: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch[n].to_pylist() for n in batch.schema.names)):
            if held and row[:2] != current:
                out += _block_windows(current, held, budget, history)
                size += sum(len(r[4]) for r in held)
                held = []
                if size > CHUNK_BYTES:
                    yield _window_batch(out)
                    out, size = [], 0
            current = row[:2]
            held.append(row)
    if held:
        out += _block_windows(current, held, budget, history)
    if out:
        yield _window_batch(out)


def _block_windows(key: tuple, rows: list[tuple], budget: int, history: int) -> list[tuple]:
    """Windows of one block; rows are its system copy, history copies and own turns, in order."""
    turns = [r for r in rows if r[2]]
    copied = sum(r[2] == 1 for r in rows)
    system = rows[0] if not rows[0][2] else None
    if system is None and key[1] == 0 and turns[0][3] == "system":
        system, first_free = turns[0], 1  # the system turn of the first block is never history
    else:
        first_free = 0
    prefix = np.concatenate([[0], np.cumsum([r[5] for r in turns])])
    out = []
    at = copied
    while at < len(turns):
        has_system = system is not None and not (first_free and at == 0) and system[5] + turns[at][5] <= budget
        base = system[5] if has_system else 0
        room = max(0, min(history, budget - base - turns[at][5]))
        back = int(np.searchsorted(prefix, prefix[at] - room))
        back = min(max(back, first_free), at)
        base += int(prefix[at] - prefix[back])
        end = max(at + 1, int(np.searchsorted(prefix, prefix[at] + budget - base, side="right")) - 1)
        parts, loss, length = [], [], 0
        repeated = ([system] if has_system else []) + turns[back:at]
        for k, (_, _, _, role, text, _) in enumerate(repeated + turns[at:end]):
            rendered, place = render(role, text)
            if k >= len(repeated) and role == "assistant":
                loss.append({"start": length + place, "end": length + len(rendered) - len(END) - 1})
            parts.append(rendered)
            length += len(rendered)
        tokens = base + int(prefix[end] - prefix[at])
        out.append((*key, len(out), "".join(parts), loss, len(repeated), len(parts), tokens))
        at = end
    return out


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_WINDOW = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("window", pa.int32()), ("formatted", pa.string()), ("loss", _SPAN)]
    + [("repeated", pa.int32()), ("n_turns", pa.int32()), ("tokens", pa.int64())]
)


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _WINDOW)], schema=_WINDOW)


def digest(windows: DataFrame) -> DataFrame:
    """What is read back from the windows, per conversation.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of each new turn),
    loss_chars, loss_sha256 (the texts under the loss mask, unescaped), formatted_chars.
    A digest runs over its conversation in order; its task streams the windows and holds
    one at a time.
    """
    dealt = windows.select("conv_id", "block", "window", "formatted", "loss", "repeated").repartition(
        shuffle_partitions(windows.sparkSession), "conv_id"
    )
    ordered = dealt.sortWithinPartitions("conv_id", "block", "window").drop("block", "window")
    fields = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.mapInArrow(_digests, fields)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    state: list | None = None

    def row() -> tuple:
        return state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]

    for batch in batches:
        done = []
        for conv_id, formatted, loss, repeated in zip(*(batch[n].to_pylist() for n in ("conv_id", "formatted", "loss", "repeated"))):
            if state is None or state[0] != conv_id:
                if state is not None:
                    done.append(row())
                state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(formatted)[repeated:]:
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"] : span["end"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row(), types)], names)
