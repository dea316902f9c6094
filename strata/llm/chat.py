"""Chat formatting: roles of transcript lines by a hidden Markov model.

A transcript is a sequence of lines; some carry a speaker marker, some markers are
missing or ambiguous.  Each line has a hidden state, a role and whether the line
opens a turn; it emits its marker class and its length class.  Transition and
emission tables are counted from labelled transcripts in Spark (a few hundred
numbers).  Viterbi finds the best states; runs of lines then become turns in the canonical form

    <|role|>
    text
    <|end|>

with ``<|`` inside a text written ``<\\|``.

Long conversations are no hot group: rows are range-partitioned by (conversation, turn),
so a conversation may cross tasks.  It is cut into blocks of at most ``BLOCK`` lines; a
block's max-plus matrix says how well it can lead from any state to any other.  The
blocks' matrices, one narrow row each, are chained forwards and backwards in sorted
streams, and every block is then decoded between its known end states.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import lead_within
from .common import written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)          # role * 2, + 1 for a line that goes on
BLOCK = 256

# Fixed marker words by role.
_WORDS = {
    "system": ("system", "sys", "instruction", "instructions"),
    "user": ("user", "human", "question", "q", "me", "customer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "model"),
}
_ROLE_OF = {w: k for k, ws in enumerate(_WORDS.values()) for w in ws}
_MARKER = re.compile(r"^\s*(?:#{1,6}\s*([A-Za-z]+)\s*:?|<\|?([A-Za-z]+)\|?>\s?|\[([A-Za-z]+)\]\s?|([A-Za-z]+)\s*:)(?:\s|$)")
_MARKS = len(ROLES) + 2          # a role each, another word in marker form, none
_SIZES = 10
_OBS = _MARKS * _SIZES


def marker(line: str) -> tuple[int, int]:
    """(marker class, where the text after the marker begins)."""
    m = _MARKER.match(line)
    if not m:
        return _MARKS - 1, 0
    word = next(g for g in m.groups() if g is not None).lower()
    role = _ROLE_OF.get(word)
    return (_MARKS - 2, 0) if role is None else (role, m.end())


def observe(lines: list[str]) -> np.ndarray:
    """Marker class and length class of each line as one number."""
    return np.array([marker(x)[0] * _SIZES + min(_SIZES - 1, len(x).bit_length()) for x in lines], dtype=np.int64)


class Model:
    """Log tables: ``start`` (states), ``step`` (states, states), ``emit`` (states, observations)."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def from_counts(cls, start: np.ndarray, step: np.ndarray, mark: np.ndarray, size: np.ndarray, smooth: float = 0.5) -> Model:
        log = lambda x: np.log((x + smooth) / (x + smooth).sum(axis=-1, keepdims=True))
        emit = (log(mark)[:, :, None] + log(size)[:, None, :]).reshape(STATES, _OBS)
        step, start = log(step), log(start)
        start[1::2] = -np.inf                       # a conversation opens with a turn
        for s in range(STATES):                     # a line goes on in its own role only
            for r in range(1, STATES, 2):
                if r // 2 != s // 2:
                    step[s, r] = -np.inf
        return cls(start, step, emit)


def train(lines: DataFrame) -> Model:
    """Count the tables over labelled rows (conv_id, turn, role, text); other roles are left out.

    Lines are counted where they lie.  Which role follows which is counted over narrow rows,
    numbered without a task per conversation, so no conversation is a hot group.
    """
    names = F.array(*[F.lit(r) for r in ROLES])
    rows = lines.where(F.col("role").isin(*ROLES)).select("conv_id", "turn", (F.array_position(names, F.col("role")) - 1).cast("int").alias("r"), "text")

    def count(batches):
        total = np.zeros((STATES, STATES + 1 + _OBS))
        for batch in batches:
            for r, text in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                obs = observe((text or "").split("\n"))
                total[2 * r, STATES + 1 + obs[0]] += 1
                np.add.at(total[2 * r + 1], STATES + 1 + obs[1:], 1)
                if len(obs) > 1:
                    total[2 * r, 2 * r + 1] += 1
                    total[2 * r + 1, 2 * r + 1] += len(obs) - 2
        s, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s), pa.array(k), pa.array(total[s, k])], names=["s", "k", "n"])

    sums = rows.select("r", "text").mapInArrow(count, "s long, k long, n double").groupBy("s", "k").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((STATES, STATES + 1 + _OBS))
    for x in sums:
        table[x["s"], x["k"]] = x["n"]
    narrow = rows.select("conv_id", "turn", F.xxhash64("text").alias("tie"), "r")
    follows = lead_within(narrow, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("tie").asc_nulls_first()], F.col("r"), "after")
    for x in follows.groupBy("r", "after").count().collect():
        table[2 * x["r"], STATES] += x["count"]          # turns of a role ...
        if x["after"] is not None:
            table[2 * x["after"], STATES] -= x["count"]  # ... less those that follow another open a conversation
            table[2 * x["r"]:2 * x["r"] + 2, 2 * x["after"]] += x["count"]  # the turn before may have ended on either state
    obs = table[:, STATES + 1:].reshape(STATES, _MARKS, _SIZES)
    return Model.from_counts(table[:, STATES], table[:, :STATES], obs.sum(axis=2), obs.sum(axis=1))


def transfer(obs: np.ndarray, model: Model, opens: bool) -> np.ndarray:
    """Best log score from the state before the block (rows) to that of its last line (columns)."""
    first = np.broadcast_to(model.start, (STATES, STATES)) if opens else model.step
    score = first + model.emit[:, obs[0]]
    for o in obs[1:]:
        score = (score[:, :, None] + model.step[None]).max(axis=1) + model.emit[:, o]
    return score


def decode(obs: np.ndarray, model: Model, opens: bool, before: int, last: int) -> np.ndarray:
    """States of a block's lines between its known end states."""
    score = (model.start if opens else model.step[before]) + model.emit[:, obs[0]]
    came = np.zeros((len(obs), STATES), dtype=np.int64)
    for i, o in enumerate(obs[1:], 1):
        through = score[:, None] + model.step
        came[i] = through.argmax(axis=0)
        score = through.max(axis=0) + model.emit[:, o]
    states = np.empty(len(obs), dtype=np.int64)
    states[-1] = last
    for i in range(len(obs) - 1, 0, -1):
        states[i - 1] = came[i, states[i]]
    return states


def _blocks(rows: DataFrame, model: Model) -> DataFrame:
    """Blocks of consecutive lines of a conversation: (part, seq, conv_id, lines, obs, matrix)."""
    def run(batches):
        part, seq = TaskContext.get().partitionId(), 0
        conv, lines = None, []
        have = False

        def block():
            nonlocal seq, lines
            obs = observe(lines)
            # whether the conversation opens here is only known once all blocks are seen: both matrices
            both = np.stack([transfer(obs, model, False), transfer(obs, model, True)])
            out = (part, seq, conv, lines, obs.astype(np.int16).tobytes(), both.tobytes())
            seq, lines = seq + 1, []
            return out

        def batch_of(found):
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(
                (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary()))], names=["part", "seq", "conv_id", "lines", "obs", "matrix"])

        for batch in batches:
            found = []
            for c, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if have and c != conv and lines:
                    found.append(block())
                conv, have = c, True
                for line in (text or "").split("\n"):
                    lines.append(line)
                    if len(lines) == BLOCK:
                        found.append(block())
                if len(found) >= 512:
                    yield batch_of(found)
                    found = []
            if found:
                yield batch_of(found)
        if lines:
            yield batch_of([block()])

    order = ["conv_id", "turn", "tie"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "text")
    return written(ordered.mapInArrow(run, "part int, seq long, conv_id long, lines array<string>, obs binary, matrix binary"), "blocks")


def _forwards(batches):
    """Score of the best path into each block, by the state before it."""
    conv, alpha, begun = None, None, False
    for batch in batches:
        scores, opens = [], []
        for c, m in zip(batch.column(batch.schema.get_field_index("conv_id")).to_pylist(), batch.column(batch.schema.get_field_index("matrix")).to_pylist(), strict=True):
            new = not begun or c != conv
            conv, begun = c, True
            alpha = np.zeros(STATES) if new else alpha
            scores.append(alpha.tobytes())
            opens.append(new)
            alpha = (alpha[:, None] + np.frombuffer(m, np.float64).reshape(2, STATES, STATES)[int(new)]).max(axis=0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.binary()), pa.array(opens)], names=[*batch.schema.names, "alpha", "opens"])


def _backwards(batches):
    """The state before and at the end of each block, from the conversation's last block on."""
    conv, want, begun = None, 0, False
    for batch in batches:
        col = lambda n, b=batch: b.column(b.schema.get_field_index(n)).to_pylist()
        before, last = [], []
        for c, m, a, opens in zip(col("conv_id"), col("matrix"), col("alpha"), col("opens"), strict=True):
            through = np.frombuffer(a, np.float64)[:, None] + np.frombuffer(m, np.float64).reshape(2, STATES, STATES)[int(opens)]
            end = int(through.max(axis=0).argmax()) if not begun or c != conv else want
            conv, begun = c, True
            want = int(through[:, end].argmax())
            before.append(want)
            last.append(end)
        keep = [batch.column(batch.schema.get_field_index(n)) for n in ("part", "seq", "opens")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(before, pa.int32()), pa.array(last, pa.int32())], names=["part", "seq", "opens", "before", "last"])


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """Recovered turns of transcripts (conv_id, turn, text): conv_id, turn, piece, role, n_lines, rendered.

    ``turn`` counts from 0 in each conversation; a turn that crosses blocks has several
    pieces, whose ``rendered`` strings joined in order are the canonical turn (no limit on a
    turn's length gathers it in one row).  Rows of one conversation are read by turn, nulls
    first, ties by a hash of the text; a null text is one empty line, null conv_ids are one conversation.
    Texts may be of any length (blocks cut them); other columns are not read.
    """
    rows = transcripts.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64("text").alias("tie"), "text")
    blocks = _blocks(rows, model)
    narrow = blocks.select("part", "seq", "conv_id", "matrix")
    forth = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq").mapInArrow(
        _forwards, "part int, seq long, conv_id long, matrix binary, alpha binary, opens boolean")
    back = forth.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("part").desc(), F.col("seq").desc())
    ends = back.mapInArrow(_backwards, "part int, seq long, opens boolean, before int, last int")

    def render(batches):
        for batch in batches:
            out = []
            col = lambda n, b=batch: b.column(b.schema.get_field_index(n)).to_pylist()
            for part, seq, conv, lines, obs, opens, before, last in zip(*(col(n) for n in ("part", "seq", "conv_id", "lines", "obs", "opens", "before", "last")), strict=True):
                states = decode(np.frombuffer(obs, np.int16).astype(np.int64), model, opens, before, last)
                cuts = np.flatnonzero(states % 2 == 0).tolist()
                cuts = cuts if cuts and cuts[0] == 0 else [0, *cuts]
                for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(lines)], strict=True)):
                    role, begins = ROLES[states[a] // 2], states[a] % 2 == 0
                    text = list(lines[a:b])
                    if begins:
                        m, cut = marker(text[0])
                        text[0] = text[0][cut:] if m == states[a] // 2 else text[0]
                        if cut and not text[0]:
                            del text[0]  # the marker has a line of its own
                    body = "".join(f"\n{x}" for x in text).replace("<|", "<\\|")
                    head = f"<|{role}|>" if begins else ""
                    tail = "\n<|end|>\n" if b < len(lines) else ""  # the last piece of a block may go on in the next
                    out.append((part, seq, k, conv, bool(begins), role, b - a, head + body + tail, b == len(lines)))
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)],
                                             names=["part", "seq", "k", "conv_id", "begins", "role", "n_lines", "rendered", "open"])

    joined = blocks.join(ends, ["part", "seq"]).select("part", "seq", "conv_id", "lines", "obs", "opens", "before", "last")
    pieces = written(joined.mapInArrow(render, "part int, seq long, k int, conv_id long, begins boolean, role string, n_lines int, rendered string, open boolean"), "pieces")
    # number the turns by counts of whole blocks, then inside blocks
    first = F.min(F.struct("k", "begins"))["begins"]
    per = pieces.groupBy("conv_id", "part", "seq").agg(F.sum(F.col("begins").cast("int")).alias("n"), first.alias("fresh"))
    run = Window.partitionBy("conv_id").orderBy("part", "seq")
    per = per.select("part", "seq", F.coalesce(F.sum("n").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
                     F.coalesce(F.lead("fresh").over(run), F.lit(True)).alias("closes"),
                     F.row_number().over(run).alias("block"))
    inside = Window.partitionBy("part", "seq").orderBy("k")
    numbered = pieces.join(per, ["part", "seq"]).withColumn("at", F.sum(F.col("begins").cast("int")).over(inside))
    return numbered.select("conv_id", (F.col("earlier") + F.col("at") - 1).cast("long").alias("turn"), F.col("block").cast("long").alias("piece"), "role", "n_lines",
                           F.concat("rendered", F.when(F.col("open") & F.col("closes"), F.lit("\n<|end|>\n")).otherwise(F.lit(""))).alias("rendered"))


# How a platform prints its speakers, by style; the empty style prints none.
STYLES = ("{R}: ", "### {r}\n", "<|{r}|> ", "[{R}] ", "")
NAMES = {"system": ("System", "Instructions"), "user": ("User", "Human"), "assistant": ("Assistant", "AI")}


def print_transcripts(conversations: DataFrame) -> DataFrame:
    """Raw transcripts (conv_id, turn, role, text) as chat platforms print them.

    A conversation's style and names follow from a hash of its id; every seventh marker is missing.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    naming = F.pmod(F.xxhash64("conv_id", F.lit(1)), F.lit(2))
    name = F.lit(None).cast("string")
    for role, names in NAMES.items():
        name = F.when(F.col("role") == role, F.when(naming == 0, F.lit(names[0])).otherwise(F.lit(names[1]))).otherwise(name)
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(7)) == 0
    text = F.coalesce("text", F.lit(""))
    shown = F.lit("")
    for k, s in enumerate(STYLES):
        before, _, after = s.partition("{R}") if "{R}" in s else s.partition("{r}")
        printed = F.concat(F.lit(before), name if "{R}" in s else F.lower(name), F.lit(after)) if s else F.lit("")
        shown = F.when(style == k, printed).otherwise(shown)
    return conversations.select("conv_id", "turn", "role", F.concat(F.when(lost, F.lit("")).otherwise(F.coalesce(shown, F.lit(""))), text).alias("text"))


def chat_report(conversations: DataFrame) -> DataFrame:
    """Parse the printed transcripts of all conversations; the tables are counted on four fifths of them."""
    printed = print_transcripts(conversations)
    held = F.crc32(F.encode(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), "UTF-8")) % 5 == 0
    return parse(printed, train(printed.where(~held)))
