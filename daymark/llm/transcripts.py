"""Chat transcripts: roles by a hidden Markov model, then canonical turns.

A transcript is the text of a conversation's rows in the order of ``turn``. Every line is
an observation: whether it begins a row, whether it begins with a speaker marker and of
which kind, its length, how it ends, and, at the head of a row, the row's length. The hidden state is the role that speaks. Start,
transition and emission probabilities are smoothed counts over all rows with a role in
``role``; between rows the speaker moves by one transition matrix, and inside a row only a
line with a marker may change it. Viterbi decoding recovers the roles; ``role`` itself is
no input of it. Lines are then joined into turns and rendered.

Long conversations are decoded in pieces. In max-plus algebra a run of up to 256 rows is one
small matrix, from states before the run to states at its end. Matrices are chained forward
and back as a stream, and each run is then decoded by itself, between known scores in front
of it and the known state at its end. No task holds a conversation.

The result has one row per row: its lines belong to one or several turns. A new row is a new
turn, also by the same speaker.

Rows: rows with a null conversation id form one conversation; a null turn comes first. Rows
with the same turn are ordered by text, repeated rows stay. A null or empty text is one
empty line. A null role is not counted. Without any labelled row all lines are ``user``.
An empty table gives no rows. Equal probabilities go to the role that is first by name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daymark.llm.common import stored

RUN = 256
#: Names that speakers go by in transcripts, by role: fixed values.
MARKERS = {
    "assistant": ("assistant", "ai", "bot", "model", "gpt"),
    "system": ("system", "instructions", "context"),
    "tool": ("tool", "function", "observation"),
    "user": ("user", "human", "customer", "question", "prompter"),
}
NAMED = {name: role for role, names in MARKERS.items() for name in names}
MARKER = re.compile(
    r"^\s{0,3}(?:<\|(?:im_start\|>)?|\[|#{1,4} ?|\*\*)?(" + "|".join(sorted(NAMED)) + r")(?:\|>|\]|\*\*)?\s?(?::\*{0,2}|(?<=[|>\]])|$)\s?",
    re.IGNORECASE,
)
NO_MARKER = "none"
KINDS = (NO_MARKER, *sorted(MARKERS))
LENGTHS = (0, 20, 50, 100, 200, 400, 800, 1600)
ENDS = ("", ".", "?", "!", ":", "other")
FAMILIES = ("marker", "length", "end", "row")
SMOOTHING = 0.5
#: More distinct roles than this are refused.
MOST_ROLES = 64


@dataclass
class Model:
    """Logarithms of all probabilities."""

    roles: list[str]
    start: np.ndarray
    move: np.ndarray
    marker: np.ndarray
    length: np.ndarray
    end: np.ndarray
    row: np.ndarray

    def emission(self, seen: np.ndarray) -> np.ndarray:
        """Lines by roles, from the columns marker, length, end and row of ``seen``."""
        heads = np.where(seen[:, 0] > 0, self.row[:, seen[:, 4]], 0.0)
        return (self.marker[:, seen[:, 1]] + self.length[:, seen[:, 2]] + self.end[:, seen[:, 3]] + heads).T

    def step(self, first_line: int, marker: int) -> np.ndarray:
        """Transition into a line: between rows, at a marker inside a row, or none."""
        if first_line or marker:
            return self.move
        return np.where(np.eye(len(self.roles)) > 0, 0.0, -np.inf)


def observe(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """Begins the row, marker, length class, ending and the row's length class, by line."""
    out = []
    row = int(np.searchsorted(LENGTHS, len(text or "")))
    for i, line in enumerate((text or "").split("\n")):
        found = MARKER.match(line)
        kind = KINDS.index(NAMED[found.group(1).lower()]) if found else 0
        size = int(np.searchsorted(LENGTHS, len(line)))
        last = line.rstrip()[-1:]
        out.append((int(i == 0), kind, size, ENDS.index(last) if last in ENDS else len(ENDS) - 1, row))
    return out


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of features per role: of lines, of starts, and of moves between rows."""
    counts: Counter = Counter()
    for batch in batches:
        for rows in batch.column(0).to_pylist():
            before = None
            for i, r in enumerate(rows):
                role = r["role"]
                if role is not None:
                    for line in observe(r["text"]):
                        counts.update((role, family, str(value)) for family, value in zip(FAMILIES[: 3 + line[0]], line[1:]))
                    if before is not None:
                        counts[role, "move", before] += 1
                    elif i == 0 and (r["turn"] is None or r["turn"] < RUN):
                        counts[role, "start", ""] += 1
                before = role
    columns = list(zip(*[(*k, n) for k, n in counts.items()], strict=True)) or [[], [], [], []]
    types = (pa.string(), pa.string(), pa.string(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["role", "family", "value", "n"])


def in_runs(rows: DataFrame) -> DataFrame:
    """conv_id, stretch, part and rows (turn, role, text) of each run, in order.

    A stretch is 256 turns by number; more rows than that in it are cut into parts.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), "text")
    rows = rows.withColumn("stretch", F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 60))))
    order = W.partitionBy("conv_id", "stretch").orderBy(F.asc_nulls_first("turn"), F.asc_nulls_first("text"), F.asc_nulls_first("role"))
    placed = rows.withColumn("at", F.row_number().over(order) - 1).withColumn("part", F.floor(F.col("at") / RUN))
    made = placed.groupBy("conv_id", "stretch", "part").agg(F.sort_array(F.collect_list(F.struct("at", "turn", "role", "text"))).alias("rows"))
    return made.select("conv_id", "stretch", "part", F.transform("rows", lambda r: F.struct(r["turn"].alias("turn"), r["role"].alias("role"), r["text"].alias("text"))).alias("rows"))


def train(runs: DataFrame) -> Model:
    """Smoothed counts over all labelled rows; a few numbers per role reach the driver."""
    counts = runs.select("rows").mapInArrow(_observed, "role string, family string, value string, n long")
    table = counts.groupBy("role", "family", "value").agg(F.sum("n").alias("n"))
    roles = sorted(r["role"] for r in table.select("role").distinct().limit(MOST_ROLES + 1).collect())
    if len(roles) > MOST_ROLES:
        raise ValueError(f"more than {MOST_ROLES} distinct roles")
    roles = roles or ["user"]
    n = len(roles)
    at = {r: i for i, r in enumerate(roles)}
    start, move = np.full(n, SMOOTHING), np.full((n, n), SMOOTHING)
    sizes = {"marker": len(KINDS), "length": len(LENGTHS) + 1, "end": len(ENDS), "row": len(LENGTHS) + 1}
    families = {name: np.full((n, size), SMOOTHING) for name, size in sizes.items()}
    # A marker names its role, also where no labelled row shows one.
    for role, i in at.items():
        if role in KINDS:
            families["marker"][i, KINDS.index(role)] += 20
    for r in table.collect():
        if r["family"] == "start":
            start[at[r["role"]]] += r["n"]
        elif r["family"] == "move":
            if r["value"] in at:
                move[at[r["value"]], at[r["role"]]] += r["n"]
        else:
            families[r["family"]][at[r["role"]], int(r["value"])] += r["n"]
    logs = [np.log(x / x.sum(axis=-1, keepdims=True)) for x in (start, move, *[families[f] for f in FAMILIES])]
    return Model(roles, *logs)


def _lines(texts: list[str | None]) -> np.ndarray:
    return np.array([line for text in texts for line in observe(text)], np.int64).reshape(-1, 5)


def run_matrix(model: Model, seen: np.ndarray) -> np.ndarray:
    """Best log probability of a run for each state in front of it (the last one: nothing,
    at the start of a conversation) and each state at its end."""
    emission = model.emission(seen)
    total = np.vstack([model.move, model.start])
    total = total + emission[0]
    for line, e in zip(seen[1:], emission[1:], strict=True):
        total = (total[:, :, None] + model.step(line[0], line[1])[None, :, :]).max(axis=1) + e
    return total


def viterbi(model: Model, seen: np.ndarray, entry: np.ndarray, last: int) -> np.ndarray:
    """The best states of a run, from scores of the states in front to its last state."""
    emission = model.emission(seen)
    score = (entry[:, None] + np.vstack([model.move, model.start])).max(axis=0) + emission[0]
    back = []
    for line, e in zip(seen[1:], emission[1:], strict=True):
        ways = score[:, None] + model.step(line[0], line[1])
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + e
    state, path = last, [last]
    for b in back[::-1]:
        state = int(b[state])
        path.append(state)
    return np.array(path[::-1])


KEY = ["conv_id", "stretch", "part"]


def _streamed(df: DataFrame, ddl: str, step: Callable[[dict, object, bool], tuple[dict, object]], *, forward: bool) -> DataFrame:
    """Runs of each conversation one after the other, with a state that is handed on."""
    names = [f.strip().split(" ")[0] for f in ddl.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conversation, fresh = None, None, True
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                begins = fresh or row["conv_id"] != conversation
                conversation, fresh = row["conv_id"], False
                made, state = step(row, state, begins)
                out.append(made)
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(n, types[n]) for n in names]))

    arrow = {"conv_id": pa.int64(), "stretch": pa.int64(), "part": pa.int64(), "last": pa.int32()}
    types = {n: arrow.get(n, pa.list_(pa.float64())) for n in names}
    order = [F.col(c).asc_nulls_first() if forward else F.col(c).desc_nulls_last() for c in KEY]
    return df.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, ddl)


def decode(runs: DataFrame, model: Model) -> DataFrame:
    """conv_id, turn, role, roles, n_turns and rendered of each row."""
    n = len(model.roles)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [run_matrix(model, _lines([r["text"] for r in rows])).reshape(-1) for rows in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.list_(pa.float64()))], names=[*KEY, "matrix"])

    def ahead(row: dict, score: np.ndarray | None, begins: bool) -> tuple[dict, np.ndarray]:
        entry = np.append(np.full(n, -np.inf), 0.0) if begins else np.append(score, -np.inf)
        matrix = np.array(row["matrix"]).reshape(n + 1, n)
        score = (entry[:, None] + matrix).max(axis=0)
        return row | {"entry": entry, "score": score}, score

    def behind(row: dict, wanted: int | None, begins: bool) -> tuple[dict, int]:
        last = int(np.argmax(row["score"])) if begins else wanted
        ways = np.array(row["entry"]) + np.array(row["matrix"]).reshape(n + 1, n)[:, last]
        return {k: row[k] for k in (*KEY, "entry")} | {"last": last}, int(np.argmax(ways))

    def turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for run in batch.to_pylist():
                texts = [r["text"] or "" for r in run["rows"]]
                states = iter(viterbi(model, _lines(texts), np.array(run["entry"]), run["last"]))
                for r, text in zip(run["rows"], texts, strict=True):
                    lines = text.split("\n")
                    roles = [model.roles[next(states)] for _ in lines]
                    spoken = [x for i, x in enumerate(roles) if i == 0 or x != roles[i - 1]]
                    out.append({"conv_id": run["conv_id"], "turn": r["turn"], "role": r["role"], "roles": ",".join(spoken), "n_turns": len(spoken), "rendered": render(roles, lines)})
            yield pa.RecordBatch.from_pylist(out, schema=RESULT)

    made = runs.select(*KEY, "rows").mapInArrow(matrices, "conv_id long, stretch long, part long, matrix array<double>")
    made = _streamed(made, "conv_id long, stretch long, part long, matrix array<double>, entry array<double>, score array<double>", ahead, forward=True)
    made = _streamed(made, "conv_id long, stretch long, part long, entry array<double>, last int", behind, forward=False)
    made = stored(made, "states").select(F.col("conv_id").alias("c"), F.col("stretch").alias("s"), F.col("part").alias("p"), "entry", "last")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("stretch") == F.col("s")) & (F.col("part") == F.col("p"))
    joined = runs.join(made, same).select("conv_id", "rows", "entry", "last")
    return joined.mapInArrow(turns, "conv_id long, turn long, role string, roles string, n_turns long, rendered string")


RESULT = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("roles", pa.string()), ("n_turns", pa.int64()), ("rendered", pa.string())]
)


def render(roles: list[str], lines: list[str]) -> str:
    """Turns in canonical form; a marker goes where its line opens a turn of the role that it
    names, and stays as ordinary text elsewhere."""
    turns: list[tuple[str, list[str]]] = []
    for role, line in zip(roles, lines, strict=True):
        if not turns or turns[-1][0] != role:
            turns.append((role, []))
            found = MARKER.match(line)
            if found and NAMED[found.group(1).lower()] == role:
                line = line[found.end() :]
        turns[-1][1].append(line)
    return "\n".join(f"<|{role}|>\n" + "\n".join(body) + "\n<|end|>" for role, body in turns)


def canonical(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` (conv_id, turn, role, text) with recovered roles.

    ``role`` is what the row says, ``roles`` what decoding found for its turns, ``rendered``
    the row in canonical form.
    """
    runs = stored(in_runs(conversations.withColumn("conv_id", F.col("conv_id").cast("long"))), "runs")
    return decode(runs, train(runs))
