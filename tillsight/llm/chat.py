"""Operator 8, chat formatting: a hidden Markov model over transcript lines.

A line's state is a role (system, user, assistant) and whether it begins a turn
or continues one. It shows features: the speaker marker in front of it (a known
one, an unknown one, none), whether a blank line or a bare marker line precedes
it, how long it is, and whether it asks. Transitions and features are counted
on transcripts with known roles, over all of them and in parallel; Viterbi finds
the likeliest states, which give turns without their markers, and these are
rendered in one canonical form.

Transcripts are rows of text. ``transcripts`` makes them of a table of turns,
each conversation in a style chosen by a hash of its id, now and then without
a marker, at most ``TURNS`` turns in one; a longer conversation gives several.
No group is larger than that, whatever one conversation holds.

Bounds: the model knows the ``MARKERS`` most frequent markers and nothing else
that grows. Defined cases: null and blank transcripts have no turns; blank
lines end nothing and vanish at a turn's edges; turns that repeat conversation,
number, role and text count once; roles other than the three are rendered
without a marker and train nothing; a null turn number comes last; without any
training row all states are equally likely but for their markers' silence, and
everything is one user turn.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, mapped, quoted, small, staged
from .quality import remainder

# Roles, and the markers of each style of transcript.
ROLES = ("system", "user", "assistant")
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Note: ", "Human: ", "AI: "),
    ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"),
    ("### System\n", "### User\n", "### Assistant\n"),
    ("Context: ", "Q: ", "A: "),
    ("Moderator: ", "{name}: ", "Bot: "),
)
NAMES = ("Anna", "Ben", "Chloe", "David", "Emma", "Felix", "Greta", "Hugo", "Ines", "Jonas")
TURNS = 200
MARKERS = 64
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
_MARKER = re.compile(r"^\s*(?:(<\|[A-Za-z]{1,20}\|>)\s*|(#{1,4} ?[A-Za-z]{1,20})\s*$|([A-Z][A-Za-z]{0,19}):(?:\s+|$))")
_SIZES = (0, 20, 60, 150, 400)


def split_marker(line: str) -> tuple[str, str]:
    """The marker of a line ("" if none) and what follows it."""
    m = _MARKER.match(line)
    return (m[m.lastindex].strip().lower(), line[m.end():]) if m else ("", line)


def lines_of(text: str):
    """Lines worth a state: (number, marker, rest, features but the marker)."""
    out, gap, bare = [], True, False
    for i, line in enumerate(text.split("\n")):
        if not line.strip():
            gap = True
            continue
        marker, rest = split_marker(line)
        size = sum(len(rest) > s for s in _SIZES)
        out.append((i, marker, rest, (f"gap{int(gap)}{int(bare)}", f"size{size}", f"asks{int(rest.rstrip().endswith('?'))}")))
        gap, bare = False, bool(marker) and not rest.strip()
    return out


def transcripts(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``text`` and, of the same lines, ``roles``: the
    role given for each line of the text (null if none)."""
    role = F.lower(F.col("role"))
    known = F.when(role.isin(*ROLES), role)
    kind = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    style = F.element_at(F.array(*(F.create_map(*(F.lit(x) for r, m in zip(ROLES, s) for x in (r, m))) for s in STYLES)),
                         (kind + 1).cast("int"))
    name = F.element_at(F.array(*map(F.lit, NAMES)), (F.pmod(F.xxhash64("conv_id", F.lit(1)), F.lit(len(NAMES))) + 1).cast("int"))
    silent = (F.pmod(F.xxhash64("conv_id", "turn", F.lit(2)), F.lit(12)) == 0) | known.isNull()
    marker = F.when(silent, "").otherwise(F.replace(F.element_at(style, known), F.lit("{name}"), name))
    said = F.concat(marker, F.coalesce("text", F.lit("")))
    gap = F.when(F.pmod(F.xxhash64("conv_id", F.lit(3)), F.lit(2)) == 0, "\n").otherwise("\n\n")
    rows = turns.select("conv_id", "turn", known.alias("role"), said.alias("said"), gap.alias("gap"),
                        F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-1)).alias("part")).distinct()
    rows = _spread(rows)
    parts = rows.groupBy("conv_id", "part").agg(
        F.min("gap").alias("gap"), F.array_sort(F.collect_list(F.struct(
            F.col("turn").isNull().alias("last"), "turn", "role", "said"))).alias("turns"))
    gap_lines = F.length("gap") - 1
    roles = F.flatten(F.transform("turns", lambda t, i: F.concat(
        F.array_repeat(F.lit(None).cast("string"), F.when(i > 0, gap_lines).otherwise(0)),
        F.array_repeat(t["role"], F.size(F.split(t["said"], "\n"))))))
    begins = F.flatten(F.transform("turns", lambda t, i: F.concat(
        F.array_repeat(F.lit(False), F.when(i > 0, gap_lines).otherwise(0)),
        F.transform(F.split(t["said"], "\n"), lambda x, k: k == 0))))
    return parts.select("conv_id", "part", F.call_function("array_join", F.transform("turns", lambda t: t["said"]), F.col("gap")).alias("text"),
                        roles.alias("roles"), begins.alias("begins"))


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of one conversation that share a turn number, or have none, don't
    say their order. Where there are more than ``TURNS`` of them they are dealt by
    hash into further parts (numbered from 2**32 on), so that no group follows
    one conversation."""
    crowds = staged(rows.groupBy("conv_id", "turn").agg(F.count("*").alias("crowd")).filter(F.col("crowd") > TURNS)
                    .select(F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "crowd"), "chat-crowds")
    if crowds.isEmpty():
        return rows
    nth = F.pmod(F.xxhash64("role", "said"), F.ceil(F.col("crowd") / TURNS))
    return (rows.join(crowds, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn")), "left")
            .withColumn("part", F.col("part") + F.coalesce(nth, F.lit(0)) * F.lit(1 << 32))
            .drop("_conv", "_turn", "crowd"))


def count_features(known: DataFrame) -> DataFrame:
    """Counts of transitions and features over transcripts with roles:
    ``kind``, ``state``, ``value``, ``seen``."""
    schema = "kind string, state int, value string, seen long"

    def run(batches):
        for batch in small(batches, 0):
            counts: dict[tuple[str, int, str], int] = {}
            for text, roles, begins in zip(*(c.to_pylist() for c in batch.columns)):
                before, started = "start", -1
                for i, marker, _, features in lines_of(text or ""):
                    if roles[i] is None:
                        before = None
                        continue
                    # A turn begins with its first line that isn't blank.
                    began = next(k for k in range(i, -1, -1) if begins[k]) if any(begins[:i + 1]) else 0
                    state = STATES.index((roles[i], began != started))
                    started = began
                    if before is not None:
                        counts[("step", state, before)] = counts.get(("step", state, before), 0) + 1
                    before = str(state)
                    for kind, value in (("marker", marker), *((f[:3], f) for f in features)):
                        counts[(kind, state, value)] = counts.get((kind, state, value), 0) + 1
            if counts:
                kind, state, value = zip(*counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array(state, pa.int32()), pa.array(value), pa.array(counts.values(), pa.int64())],
                    names=["kind", "state", "value", "seen"])

    return known.select("text", "roles", "begins").mapInArrow(run, schema) \
        .groupBy("kind", "state", "value").agg(F.sum("seen").alias("seen"))


class Model:
    """Log probabilities of the hidden Markov model."""

    def __init__(self, counts: list[tuple[str, int, str, int]]):
        n = len(STATES)
        step, start = np.full((n, n), 0.1), np.full(n, 0.1)
        features: dict[str, dict[str, np.ndarray]] = {}
        for kind, state, value, seen in counts:
            if kind == "step" and value == "start":
                start[state] += seen
            elif kind == "step":
                step[int(value), state] += seen
            else:
                features.setdefault(kind, {}).setdefault(value, np.zeros(n))[state] += seen
        # A marker that is rare stands for all that are unknown.
        marks = features.get("marker", {})
        common = sorted((m for m in marks if m), key=lambda m: (-marks[m].sum(), m))[:MARKERS]
        rare = [marks[m] for m in marks if m and (m not in common or marks[m].sum() < 3)]
        features["marker"] = {m: v for m, v in marks.items() if not m or (m in common and marks[m].sum() >= 3)}
        unknown = sum(rare, np.zeros(n))
        # Unknown markers begin a turn, of whichever role.
        features["marker"]["other"] = unknown + np.array([1.0 if begins else 0.0 for _, begins in STATES])
        features["marker"].setdefault("", np.array([0.1 if begins else 1.0 for _, begins in STATES]))
        # A start state isn't followed by another role's continuation.
        for i, (role, _) in enumerate(STATES):
            for j, (other, begins) in enumerate(STATES):
                if role != other and not begins:
                    step[i, j] = 1e-6
        start[[j for j, (_, begins) in enumerate(STATES) if not begins]] = 1e-6
        self.start, self.step = np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True))
        self.features = {}
        for kind, values in features.items():
            total = sum(values.values()) + 0.1 * (len(values) + 1)
            self.features[kind] = {v: np.log((c + 0.1) / total) for v, c in values.items()}

    def emission(self, marker: str, features) -> np.ndarray:
        marks = self.features["marker"]
        out = marks.get(marker, marks["other"]).copy()
        for f in features:
            values = self.features.get(f[:3], {})
            if f in values:
                out += values[f]
        return out

    def states(self, lines) -> list[int]:
        """The likeliest states of the lines of a transcript (Viterbi)."""
        if not lines:
            return []
        best, back = None, []
        for _, marker, _, features in lines:
            seen = self.emission(marker, features)
            if best is None:
                best = self.start + seen
                continue
            ways = best[:, None] + self.step
            back.append(ways.argmax(0))
            best = ways.max(0) + seen
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]


def turns_of(model: Model, text: str) -> tuple[list[tuple[str, str]], list[tuple[int, str]]]:
    """(role, text) of the turns of a transcript, and (line, role) of its
    lines."""
    lines, rows = lines_of(text), text.split("\n")
    path = model.states(lines)
    turns, roles, last = [], [], -1
    for (i, _, rest, _), state in zip(lines, path):
        role, begins = STATES[state]
        roles.append((i, role))
        if begins or not turns:
            turns.append([role, [rest]])
        else:
            turns[-1][1] += rows[last + 1:i] + [rows[i]]
        last = i
    return [(role, "\n".join(said).strip()) for role, said in turns], roles


def render(turns: list[tuple[str, str]]) -> str:
    """The canonical form."""
    return "".join(f"<|{role}|>\n{said}\n<|end|>\n" for role, said in turns)


def train(known: DataFrame) -> Model:
    """A model of transcripts with ``text``, ``roles`` and ``begins``. Of the
    marker counts only the most frequent reach the driver, and the sum of all
    others."""
    counts = count_features(known)
    marks = counts.filter((F.col("kind") == "marker") & (F.col("value") != "")) \
        .groupBy("value").agg(F.sum("seen").alias("all")).orderBy(F.desc("all"), "value").limit(MARKERS).select("value")
    named = counts.join(F.broadcast(marks.withColumn("named", F.lit(True))), "value", "left").select(
        "kind", "state", F.when((F.col("kind") != "marker") | (F.col("value") == "") | F.col("named"), F.col("value"))
        .otherwise(F.lit("other")).alias("value"), "seen")
    rows = named.groupBy("kind", "state", "value").agg(F.sum("seen").alias("seen")).collect()
    return Model(sorted((r.kind, r.state, r.value, r.seen) for r in rows))


def format_chats(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with ``rendered``, ``turn_roles`` and ``line_roles`` (the role
    of each line, null for a blank one), and the names that these got."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = {k: fresh(k, docs.columns) for k in ("rendered", "turn_roles", "line_roles")}

    def work():
        model = held.value

        def run(columns: list[pa.Array]) -> list[pa.Array]:
            rendered, roles, by_line = [], [], []
            for text in columns[0]:
                text = text.as_py() or ""
                turns, lines = turns_of(model, text)
                each = [None] * (text.count("\n") + 1)
                for i, role in lines:
                    each[i] = role
                rendered.append(render(turns))
                roles.append([role for role, _ in turns])
                by_line.append(each)
            strings = pa.list_(pa.string())
            return [pa.array(rendered, pa.string()), pa.array(roles, strings), pa.array(by_line, strings)]

        return run

    strings = T.ArrayType(T.StringType())
    return mapped(docs, [text_col], [T.StructField(names["rendered"], T.StringType()), T.StructField(names["turn_roles"], strings),
                                     T.StructField(names["line_roles"], strings)], work), names


def report(turns: DataFrame) -> DataFrame:
    """Per transcript: its turns in canonical form, and how many lines got the
    role that the table gives. Conversations of remainder 0 modulo 5 train
    nothing."""
    made = staged(transcripts(turns.select("conv_id", "turn", "role", "text")), "chat-transcripts")
    model = train(made.filter(remainder("conv_id", 5) != 0))
    out, names = format_chats(made, model)
    line = F.arrays_zip(F.col("roles").alias("given"), quoted(names["line_roles"]).alias("found"))
    known = F.filter(line, lambda x: x["given"].isNotNull() & x["found"].isNotNull())
    return out.select(
        "conv_id", "part", (remainder("conv_id", 5) == 0).alias("held_out"),
        F.size(quoted(names["turn_roles"])).cast("long").alias("n_turns"), F.size(known).cast("long").alias("n_lines"),
        F.size(F.filter(known, lambda x: x["given"] == x["found"])).cast("long").alias("n_right"),
        F.array_join(quoted(names["turn_roles"]), ",").alias("roles"), quoted(names["rendered"]).alias("rendered"))
