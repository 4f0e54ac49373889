"""Chat formatting: roles of raw transcripts by a hidden Markov model (operator 3).

States are (role, first line of a turn or a later one). What a line shows, its
speaker marker, length, ending and beginning, is scored by smoothed frequencies
from labelled conversations; Viterbi finds the likeliest states, and lines of one
turn are rendered in canonical form.

A conversation is decoded in segments of its line numbers, so one that holds a
third of all lines is many tasks: Viterbi is a product of max-plus matrices, each
segment sends one small matrix, the best states at the borders follow from these,
and segments are then decoded between fixed borders. The result is that of one
pass over the whole conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.textops import runs
from tallyhouse.sources.scratch import materialize

# Roles, and names that markers give them.
ROLES = ["system", "user", "assistant"]
NAMES = {
    "system": ["system", "sys", "instructions", "instruction"],
    "user": ["user", "human", "question", "q", "customer"],
    "assistant": ["assistant", "bot", "ai", "answer", "a", "model"],
}
MARKER = r"(?i)^[\s>*#\[<|]*(%s)[\s*\]|>]*[:\]>]+[\s*]*" % "|".join(n for names in NAMES.values() for n in names)
STATES = [(role, begins) for role in ROLES for begins in (True, False)]
#: Conversations, and turns of each, that the model is fitted on at most.
FITTED, FITTED_TURNS = 2_000, 64
SEED = 3
#: Line numbers of a turn start this far apart; turns of one segment.
LINE_SPAN, SEGMENT_TURNS = 1 << 20, 256
FEATURES = {"marker": 4, "length": 14, "ending": 4, "opening": 3}


def features(line: Column) -> dict[str, Column]:
    """Small numbers that describe a line."""
    name = F.lower(F.regexp_extract(line, MARKER, 1))
    marker = F.lit(0)
    for k, role in enumerate(ROLES, 1):
        marker = F.when(name.isin(NAMES[role]), k).otherwise(marker)
    body = F.trim(F.regexp_replace(line, MARKER, ""))
    return {
        "marker": marker,
        "length": F.least(F.floor(F.log2(F.length(body) + 1)), F.lit(13)).cast("int"),
        "ending": F.when(body.endswith("?"), 1).when(body.endswith("."), 2).when(body == "", 3).otherwise(0),
        "opening": F.when(body.rlike(r"^\p{Lu}"), 1).when(body.rlike(r"^\p{L}"), 2).otherwise(0),
    }


@dataclass
class Model:
    first: np.ndarray
    step: np.ndarray
    shown: dict[str, np.ndarray]

    def scores(self, lines: pd.DataFrame) -> np.ndarray:
        """Log scores of the states at each line."""
        return sum(table[:, lines[name].to_numpy(dtype=np.int64)].T for name, table in self.shown.items())

    def passed(self, scores: np.ndarray) -> np.ndarray:
        """The max-plus matrix of a segment: from the state before it to its last one."""
        out = self.step + scores[0]
        for line in scores[1:]:
            out = (out[:, :, None] + self.step[None]).max(axis=1) + line
        return out

    def decode(self, scores: np.ndarray, before: int | None, last: int | None) -> list[int]:
        """The best states of a segment, between fixed border states where given."""
        value = (self.first if before is None else self.step[before]) + scores[0]
        back = []
        for line in scores[1:]:
            reach = value[:, None] + self.step
            back.append(reach.argmax(axis=0))
            value = reach.max(axis=0) + line
        states = [int(value.argmax()) if last is None else last]
        for choice in reversed(back):
            states.append(int(choice[states[-1]]))
        return states[::-1]


def fit(labelled: DataFrame, conversations: int = FITTED, turns: int = FITTED_TURNS) -> Model:
    """A model from (conv_id, turn, line_no, line, role), `pos` 0 at the first line of a turn.

    At most `conversations` conversations, the least by a seeded hash, and their
    first `turns` turns are used. Without any, all states are as likely.
    """
    chosen = (
        labelled.select("conv_id").distinct().orderBy(F.xxhash64(F.lit(SEED), "conv_id"), "conv_id").limit(conversations)
    )
    state = F.lit(None).cast("int")
    for k, (role, begins) in enumerate(STATES):
        state = F.when((F.col("role") == role) & ((F.col("pos") == 0) == F.lit(begins)), k).otherwise(state)
    rows = (
        labelled.where(F.col("turn") < turns)
        .join(F.broadcast(chosen), "conv_id", "left_semi")
        .select("conv_id", "line_no", "line", state.alias("state"), *[c.alias(n) for n, c in features(F.col("line")).items()])
        .where("state IS NOT NULL")
    )
    ordered = Window.partitionBy("conv_id").orderBy("line_no", "line")
    rows = rows.withColumn("before", F.lag("state").over(ordered))
    size = len(STATES)
    first, step = np.zeros(size), np.zeros((size, size))
    shown = {name: np.zeros((size, n)) for name, n in FEATURES.items()}
    # counts of states and of feature values: a bounded table
    for r in rows.groupBy("before", "state").count().collect():
        if r.before is None:
            first[r.state] += r["count"]
        else:
            step[r.before, r.state] += r["count"]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("int").alias("value")) for n in FEATURES]))
    for r in rows.select("state", pairs.alias("f")).groupBy("state", "f.name", "f.value").count().collect():
        shown[r["name"]][r.state, r.value] += r["count"]
    # a marker speaks for its role, also where none was seen
    for k, (role, begins) in enumerate(STATES):
        shown["marker"][k, 1 + ROLES.index(role) if begins else 0] += 1
    states = _smoothed(first + step.sum(axis=0), np.full(size, 1 / size))
    return Model(
        np.log(_smoothed(first, states)),
        np.log(_smoothed(step, states)),
        {name: np.log(_smoothed(t, _shared(t))) for name, t in shown.items()},
    )


def _shared(counts: np.ndarray) -> np.ndarray:
    """Between the frequencies of all states together and equal ones."""
    even = np.full(counts.shape[1], 1 / counts.shape[1])
    return (_smoothed(counts.sum(axis=0), even) + even) / 2


def _smoothed(counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Frequencies of each row, with one more observation spread by `prior`."""
    return (counts + prior) / (counts.sum(axis=-1, keepdims=True) + 1)


def _matrices(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["conv", "segment"]):
            scores = model.scores(group)
            first = model.first + scores[0]
            if len(scores) > 1:
                first = (first[:, None] + model.passed(scores[1:])).max(axis=0)
            yield pd.DataFrame(
                {
                    "conv": [group["conv"].iloc[0]],
                    "segment": [group["segment"].iloc[0]],
                    "inner": [model.passed(scores).tobytes()],
                    "first": [first.tobytes()],
                }
            )

    return run


def _borders(rows: pd.DataFrame) -> pd.DataFrame:
    """The best state before and at the end of each segment of a conversation."""
    rows = rows.sort_values("segment", kind="stable")
    size = len(STATES)
    value = np.frombuffer(rows["first"].iloc[0])
    back = []
    for raw in rows["inner"].iloc[1:]:
        reach = value[:, None] + np.frombuffer(raw).reshape(size, size)
        back.append(reach.argmax(axis=0))
        value = reach.max(axis=0)
    last = [int(value.argmax())]
    for choice in reversed(back):
        last.append(int(choice[last[-1]]))
    last = last[::-1]
    return pd.DataFrame(
        {"conv": rows["conv"], "segment": rows["segment"], "before": [-1, *last[:-1]], "last": last}
    )


def _decoding(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in runs(batches, ["conv", "segment"]):
            before, last = int(group["before"].iloc[0]), int(group["last"].iloc[0])
            states = model.decode(model.scores(group), None if before < 0 else before, None if last < 0 else last)
            roles = [STATES[s][0] for s in states]
            earlier = [STATES[before][0] if before >= 0 else None, *roles[:-1]]
            starts = [STATES[s][1] or r != e for s, r, e in zip(states, roles, earlier)]
            yield pd.DataFrame(
                {
                    "conv": group["conv"],
                    "segment": group["segment"],
                    "line_no": group["line_no"],
                    "line": group["line"],
                    "role": roles,
                    "starts": starts,
                }
            )

    return run


def recovered_lines(lines: DataFrame, model: Model, span: int = LINE_SPAN * SEGMENT_TURNS) -> DataFrame:
    """(conv, segment, line_no, line, role, starts) of raw lines (conv_id, line_no, line)."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = F.coalesce(F.col("line").cast("string"), F.lit(""))
    shown = materialize(
        lines.select(
            # numbers with NULLs would turn into floats
            F.col("conv_id").cast("string").alias("conv"),
            F.coalesce(F.col("line_no").cast("long"), F.lit(0)).alias("line_no"),
            line.alias("line"),
            *[c.cast("int").alias(n) for n, c in features(line).items()],
        ).withColumn("segment", F.floor(F.col("line_no") / span).cast("long"))
    )
    segments = shown.select("conv", "segment").distinct()
    long = segments.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1").select(F.col("conv").alias("_c"))
    dealt = (
        shown.join(long, F.col("conv").eqNullSafe(F.col("_c")), "left_semi")
        .repartition(parts, "conv", "segment")
        .sortWithinPartitions("conv", "segment", "line_no", "line")
    )
    matrices = dealt.mapInPandas(_matrices(model), "conv string, segment long, inner binary, first binary")
    borders = matrices.groupBy("conv").applyInPandas(_borders, "conv string, segment long, before int, last int")
    borders = borders.select(F.col("conv").alias("_c"), F.col("segment").alias("_s"), "before", "last")
    bounded = shown.join(
        borders, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("segment") == F.col("_s")), "left"
    ).withColumns({n: F.coalesce(n, F.lit(-1)) for n in ("before", "last")})
    return (
        bounded.drop("_c", "_s")
        .repartition(parts, "conv", "segment")
        .sortWithinPartitions("conv", "segment", "line_no", "line")
        .mapInPandas(
            _decoding(model), "conv string, segment long, line_no long, line string, role string, starts boolean"
        )
    )


def format_chats(lines: DataFrame, model: Model, span: int = LINE_SPAN * SEGMENT_TURNS) -> DataFrame:
    """Recovered turns: (conv_id, first_line, role, n_lines, rendered).

    `lines` has conv_id, line_no (their order; NULL: 0, ties by text) and line (NULL:
    empty). Lines without a conversation form one of their own. `rendered` is the
    role in a tag, the turn's lines without markers, and an end tag. Repeated lines
    stay repeated. Other columns are not read; an empty table gives no rows.
    """
    decoded = materialize(recovered_lines(lines, model, span))
    # a turn that goes on in a later segment starts where an earlier one says
    by_segment = decoded.groupBy("conv", "segment").agg(F.max(F.when(F.col("starts"), F.col("line_no"))).alias("latest"))
    earlier = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_segment.select(
        F.col("conv").alias("_c"),
        F.col("segment").alias("_s"),
        F.last("latest", ignorenulls=True).over(earlier).alias("carried"),
    )
    within = Window.partitionBy("conv", "segment").orderBy("line_no", "line").rowsBetween(Window.unboundedPreceding, 0)
    marked = decoded.withColumn(
        "own", F.last(F.when(F.col("starts"), F.col("line_no")), ignorenulls=True).over(within)
    ).join(carried, F.col("conv").eqNullSafe(F.col("_c")) & (F.col("segment") == F.col("_s")))
    content = F.when(F.col("starts"), F.regexp_replace("line", MARKER, "")).otherwise(F.col("line"))
    turns = marked.groupBy(
        F.col("conv").alias("conv_id"), F.coalesce("own", "carried", "line_no").alias("first_line"), "role"
    ).agg(
        F.count("*").alias("n_lines"),
        F.sort_array(F.collect_list(F.struct("line_no", content.alias("text")))).alias("body"),
    )
    text = F.array_join(F.transform("body", lambda x: x["text"]), "\n")
    return turns.select(
        F.col("conv_id").cast(lines.schema["conv_id"].dataType).alias("conv_id"),
        "first_line",
        "role",
        "n_lines",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), text, F.lit("\n<|end|>")).alias("rendered"),
    )


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """Labelled raw lines from turns: one of four marker styles for a conversation, a fifth of the turns unmarked."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    role = F.coalesce("role", F.lit("user"))
    other = F.when(role == "user", "Human").when(role == "assistant", "AI").otherwise("System")
    marker = (
        F.when(style == 0, F.concat(F.initcap(role), F.lit(": ")))
        .when(style == 1, F.concat(other, F.lit(": ")))
        .when(style == 2, F.concat(F.lit("["), role, F.lit("] ")))
        .otherwise(F.concat(F.lit("**"), F.initcap(role), F.lit(":** ")))
    )
    unmarked = F.pmod(F.xxhash64("conv_id", "turn", F.lit(SEED)), F.lit(5)) == 0
    pieces = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\n")
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(0))
    rows = conversations.select(
        "conv_id", turn.alias("turn"), "role", marker.alias("marker"), unmarked.alias("unmarked"), F.posexplode(pieces).alias("pos", "piece")
    )
    first = F.when((F.col("pos") == 0) & ~F.col("unmarked"), F.concat("marker", "piece")).otherwise(F.col("piece"))
    return rows.select(
        "conv_id", "turn", "role", "pos", (F.col("turn") * LINE_SPAN + F.col("pos")).alias("line_no"), first.alias("line")
    )


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    lines = raw_transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return format_chats(lines, fit(lines))
