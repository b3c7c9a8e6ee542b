"""Chat formatting: minimum-cost repair of role sequences over a legal-turn automaton, then rendering.

Legal conversations: an optional system message, then user and assistant messages in turn,
user first, assistant last. A turn may keep its role or be relabelled; it then starts a
message, is merged into the message before it (same role), or needs one empty message of
the other role inserted before it. A last user message gets an empty answer inserted. Costs
are added up; dynamic programming finds the least.

A turn is a matrix of costs between automaton states, and blocks of turns multiply (min,
plus) to such matrices again. So a conversation of any length is cut into blocks of
``block`` elements, level by level until one block is left; best states at block borders
are then fixed from the top level down. No task holds more than a block of a conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from spotweave.llm.common import pick, small_batches, written

ROLES = ("system", "user", "assistant")
#: State: nothing yet, or the role of the last message.
START, SYSTEM, USER, ASSISTANT = range(4)
MERGE, RELABEL, INSERT = 1, 2, 3
BLOCK = 1024
_NEVER = 1 << 40
_N = 4


def steps(role: str | None) -> dict[tuple[int, int], tuple[int, str, str]]:
    """(state, next state): (cost, action, role of the message inserted before or ''), for a turn of a role.

    An unknown or null role costs a relabel whatever it becomes.
    """
    out: dict[tuple[int, int], tuple[int, str, str]] = {}
    for label in (SYSTEM, USER, ASSISTANT):
        change = 0 if role == ROLES[label - 1] else RELABEL
        for state in range(_N):
            if state == label:
                cost, action, before = MERGE, "merge", ""
            elif (state, label) in ((START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)):
                cost, action, before = 0, "message", ""
            elif label == ASSISTANT:  # from the start or a system message
                cost, action, before = INSERT, "message", "user"
            else:  # a system message can't come later
                continue
            out[state, label] = (cost + change, action, before)
    return out


_STEPS = {r: steps(r) for r in (*ROLES, None)}
#: What it costs to end in a state: a user message is answered by an empty one.
_ENDS = np.array([0, _NEVER, INSERT, 0])


def matrix(role: str | None) -> np.ndarray:
    m = np.full((_N, _N), _NEVER, np.int64)
    for (a, b), (cost, _, _) in _STEPS[role if role in ROLES else None].items():
        m[a, b] = cost
    return m


_MATRICES = {r: matrix(r) for r in (*ROLES, None)}


def product(ms: list[np.ndarray]) -> np.ndarray:
    out = ms[0]
    for m in ms[1:]:
        out = np.minimum((out[:, :, None] + m[None]).min(axis=1), _NEVER)
    return out


def best_path(ms: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """State after each matrix on a cheapest way from enter to leave; the lowest state before it on a tie."""
    cost = np.full(_N, _NEVER, np.int64)
    cost[enter] = 0
    back = []
    for m in ms:
        ways = cost[:, None] + m
        back.append(ways.argmin(axis=0))
        cost = np.minimum(ways.min(axis=0), _NEVER)
    out = [leave]
    for b in reversed(back[1:]):
        out.append(int(b[out[-1]]))
    return out[::-1]


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[dict]]:
    """Rows of one block at a time, from a partition sorted by (conversation, block, idx)."""
    key, rows = None, []
    for batch in batches:
        for r in batch.select(columns).to_pylist():
            k = (r["conv"], r["idx"] // r["size"])
            if k != key and rows:
                yield rows
                rows = []
            key = k
            rows.append(r)
    if rows:
        yield rows


def _dealt(df: DataFrame, block: int) -> DataFrame:
    small_batches(df.sparkSession)
    df = df.withColumn("size", F.lit(block)).withColumn("block", F.floor(F.col("idx") / block))
    return df.repartition("conv", "block").sortWithinPartitions("conv", "block", "idx")


def _up(df: DataFrame, block: int) -> DataFrame:
    """Blocks of a level as elements of the next: (conv, idx, m)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _groups(batches, ["conv", "idx", "size", "m"]):
            m = product([np.array(r["m"]).reshape(_N, _N) for r in rows])
            out.append({"conv": rows[0]["conv"], "idx": rows[0]["idx"] // rows[0]["size"], "m": m.reshape(-1).tolist()})
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=_UP)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_UP)

    return _dealt(df, block).mapInArrow(run, "conv string, idx long, m array<long>")


def _down(elements: DataFrame, borders: DataFrame, block: int) -> DataFrame:
    """(conv, idx, enter, leave) of every element, from those of its block."""
    wide = elements.withColumn("_b", F.floor(F.col("idx") / block)).join(
        borders.select("conv", F.col("idx").alias("_b"), "enter", "leave"), ["conv", "_b"]).drop("_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _groups(batches, ["conv", "idx", "size", "m", "enter", "leave"]):
            at = rows[0]["enter"]
            for r, s in zip(rows, best_path([np.array(r["m"]).reshape(_N, _N) for r in rows], at, rows[0]["leave"])):
                out.append({"conv": r["conv"], "idx": r["idx"], "enter": at, "leave": s})
                at = s
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=_DOWN)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_DOWN)

    return _dealt(wide, block).mapInArrow(run, "conv string, idx long, enter int, leave int")


_UP = pa.schema([("conv", pa.string()), ("idx", pa.int64()), ("m", pa.list_(pa.int64()))])
_DOWN = pa.schema([("conv", pa.string()), ("idx", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32())])


def ordered(turns: DataFrame) -> DataFrame:
    """Turns with their place ``idx`` in the conversation, from 0.

    Places come from range partitions and one offset per partition and conversation, so a
    conversation of any length is spread over tasks.
    """
    order = ["no_turn", "turn", "role", "text"]
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    keyed = turns.withColumn("conv", conv).withColumn("no_turn", F.col("turn").isNull())
    dealt = written(keyed.repartitionByRange("conv", *order).withColumn("part", F.spark_partition_id()), "turns")
    earlier = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = dealt.groupBy("part", "conv").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "conv", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    local = F.row_number().over(W.partitionBy("part", "conv").orderBy(*order))
    return dealt.withColumn("local", local).join(offsets, ["part", "conv"]).select(
        "conv", (F.col("offset") + F.col("local") - 1).alias("idx"), "conv_id", "turn", "role", "text")


def repair(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per turn row: its repaired role and action, and the text it renders to.

    Columns: conv_id, idx (place, from 0), turn, role, new_role, action (message or merge),
    inserted (role of the empty message before it, or ''), answered (an empty answer follows
    it), relabelled, cost, rendered. The rendered pieces in order of idx are the whole chat.

    Turns stand by turn number (null last), role, text; repeated rows are turns of their own.
    A null conv_id is a conversation of its own. Unknown and null roles are relabelled, a null
    text is empty. Other columns are ignored; an empty table gives no rows.
    """
    turns = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    turns = written(ordered(turns), "turns")
    costs = F.array(*[F.lit(x) for x in _MATRICES[None].reshape(-1).tolist()])
    for r in ROLES:
        costs = F.when(F.col("role") == r, F.array(*[F.lit(x) for x in _MATRICES[r].reshape(-1).tolist()])).otherwise(costs)
    levels = [turns.select("conv", "idx", costs.cast("array<long>").alias("m"))]
    longest = (turns.agg(F.max("idx")).first()[0] or 0) + 1
    while longest > 1 or len(levels) == 1:
        levels.append(written(_up(levels[-1], block), "turns"))
        longest = -(-longest // block)
    # The top: one matrix per conversation, entered at the start, left where that is cheapest.
    final = [F.col("m")[i] + int(_ENDS[i]) for i in range(_N)]
    leave = F.array_position(F.array(*final), F.array_min(F.array(*final))) - 1
    borders = levels[-1].select("conv", "idx", F.lit(START).alias("enter"), leave.cast("int").alias("leave"))
    for elements in reversed(levels[:-1]):
        borders = written(_down(elements, borders, block), "turns")
    last = turns.groupBy("conv").agg(F.max("idx").alias("last"))
    found = turns.join(borders, ["conv", "idx"]).join(last, "conv")
    table = F.create_map(*[x for i, r in enumerate(ROLES) for x in (F.lit(i + 1), F.lit(r))])
    new_role = table[F.col("leave")]
    merged = F.col("enter") == F.col("leave")
    inserted = F.when((F.col("leave") == ASSISTANT) & F.col("enter").isin(START, SYSTEM), "user").otherwise("")
    answered = (F.col("idx") == F.col("last")) & (F.col("leave") == USER)
    relabelled = ~F.col("role").eqNullSafe(new_role)
    cost = (F.when(merged, MERGE).otherwise(0) + F.when(relabelled, RELABEL).otherwise(0)
            + F.when(inserted != "", INSERT).otherwise(0) + F.when(answered, INSERT).otherwise(0))
    # A message's end mark is written by the turn that starts the next one, or by the last turn.
    close = F.when(~merged & (F.col("idx") > 0), "<|end|>\n").otherwise("")
    head = F.when(merged, "\n").otherwise(F.concat(F.lit("<|"), new_role, F.lit("|>\n")))
    tail = F.when(F.col("idx") == F.col("last"), F.concat(F.lit("<|end|>\n"), F.when(answered, "<|assistant|>\n<|end|>\n").otherwise(""))).otherwise("")
    rendered = F.concat(close, F.when(inserted != "", "<|user|>\n<|end|>\n").otherwise(""), head, F.coalesce("text", F.lit("")), tail)
    return found.select(
        "conv", "conv_id", "idx", "turn", "role", new_role.alias("new_role"), F.when(merged, "merge").otherwise("message").alias("action"),
        inserted.alias("inserted"), answered.alias("answered"), relabelled.alias("relabelled"), cost.alias("cost"), rendered.alias("rendered"))


def summary(repaired: DataFrame) -> DataFrame:
    """Per conversation: cost, edits, messages, and an order-sensitive digest of the rendered chat."""
    piece = F.xxhash64("idx", "rendered")
    return repaired.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"), F.sum("cost").alias("cost"),
        F.count_if(F.col("action") == "merge").alias("n_merges"), F.count_if("relabelled").alias("n_relabels"),
        (F.count_if(F.col("inserted") != "") + F.count_if("answered")).alias("n_inserts"),
        (F.count_if(F.col("action") == "message") + F.count_if(F.col("inserted") != "") + F.count_if("answered")).alias("n_messages"),
        F.sum(F.length("rendered")).alias("rendered_chars"), F.bit_xor(piece).alias("rendered_digest")).drop("conv")
