"""Chat formatting into a prefix tree.

Conversations that share initial turns share the nodes of those turns. A node's id is a hash of all turns up to it.
The distinct conversations are range-sorted by their paths (the ids along the way), which puts the nodes into
depth-first order: a node belongs to the first path that passes it, and is emitted once, there. Distributed prefix
sums over (path, depth) give each node its place in the packed token stream. Tokens are code points by default.

Every node carries its place, the position id of its first token (the tokens of its ancestors), and the intervals of
the stream that its tokens may attend to besides themselves: its ancestors' places, merged where they adjoin.

Texts travel with their conversations only: nodes are counted and placed by numbers alone, and a node's text is taken from
the conversation that owns it. A turn that very many conversations begin with is summed up before it is shuffled; where
conversations look up their nodes' places it is the skewed side of a sort-merge join, which adaptive execution splits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_arrow, materialise

#: Role, opening and closing control string.
ROLES = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
#: Other roles: <<ROLE:name>> text <</ROLE>>.
OTHER = ("<<ROLE:", ">>", "<</ROLE>>")
_CONTROL = re.compile(r"\\|\[(?=/?INST\])|<(?=/?s>|</?SYS>>|<ROLE:|</ROLE>>)")
_IN_NAME = re.compile(r"[\\>]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_BODY = r"((?:[^\\]|\\.)*?)"
_TURN = re.compile("|".join([*(re.escape(a) + _BODY + re.escape(b) for a, b in ROLES.values()), re.escape(OTHER[0]) + _BODY + re.escape(OTHER[1]) + _BODY + re.escape(OTHER[2])]), re.S)


def escape(text: str) -> str:
    """A backslash before each backslash and before each control string."""
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """The turn's string, and where its escaped text starts and ends in it."""
    body = escape(text or "")
    if role in ROLES:
        a, b = ROLES[role]
    else:
        a, b = OTHER[0] + _IN_NAME.sub(lambda m: "\\" + m[0], role or "") + OTHER[1], OTHER[2]
    return a + body + b, len(a), len(a) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    out, at, names = [], 0, list(ROLES)
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        k = next(i for i in range(1, 6) if m[i] is not None)
        out.append((names[k - 1], unescape(m[k])) if k <= 3 else (unescape(m[4]), unescape(m[5])))
        at = m.end()
    return out


def _append(spans: list[tuple[int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """spans and (a, b), which widens the last span if it adjoins it."""
    if a == b:
        return spans
    if spans and spans[-1][1] == a:
        return [*spans[:-1], (spans[-1][0], b)]
    return [*spans, (a, b)]


_TURNS = "array<struct<node:binary,formatted:string,loss_start:int,loss_end:int,n_tokens:int>>"


def paths(conversations: DataFrame, count_tokens: Callable[[str], int] = len) -> DataFrame:
    """A row for each conversation: conv_id, its leaf (the hash of all its turns), its path and its formatted turns.

    Turns are ordered by number, then role and text; nulls come first, a null role or text counts as empty. Rows of a null
    conv_id are one conversation. Whole texts are formatted, however long; columns other than conv_id, turn, role and text
    don't matter. An empty table gives an empty result.
    """
    c = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    c = c.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, path, turns = [], [], []
            for conv in b.column("turns").to_pylist():
                node, steps, rows = b"", [], []
                for t in conv:
                    s, a, z = format_turn(t["role"], t["text"])
                    node = hashlib.blake2b(node + s.encode("utf-8", "surrogatepass"), digest_size=16).digest()
                    steps.append(node)
                    rows.append({"node": node, "formatted": s, "loss_start": a if t["role"] == "assistant" else 0, "loss_end": z if t["role"] == "assistant" else 0, "n_tokens": count_tokens(s)})
                leaf.append(node)
                path.append(b"".join(steps))
                turns.append(rows)
            kind = pa.list_(pa.struct([("node", pa.binary()), ("formatted", pa.string()), ("loss_start", pa.int32()), ("loss_end", pa.int32()), ("n_tokens", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(leaf, pa.binary()), pa.array(path, pa.binary()), pa.array(turns, kind)], ["conv_id", "leaf", "path", "turns"])

    return in_arrow(c, run, f"conv_id long, leaf binary, path binary, turns {_TURNS}")


def pack(conversations: DataFrame, count_tokens: Callable[[str], int] = len) -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves).

    nodes, a row for each tree node: node, place (of its first token in the packed stream), n_tokens, position_id,
    attends (array of start, end: the ancestors' tokens), formatted, and the loss mask loss_start, loss_end (code points
    of formatted; empty but in assistant turns). Sorted by place, the rows are the forest depth-first.
    leaves, a row for each conversation: conv_id, leaf, n_turns; its nodes are those of its leaf.
    The DataFrame nodes has an attribute route: (leaf, depth, node), the way from the root to each leaf.

    Conversations of the same turns share all nodes. Repeated rows are turns of their own; columns of clashing names don't
    matter. Empty tables give empty ones.
    """
    convs = materialise(paths(conversations, count_tokens), "chat-paths")
    one = convs.groupBy("leaf", "path").agg(F.first("turns").alias("turns"))
    n = max(1, int(convs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the order of these rows is that of the paths; written, so that the numbers stay as they are
    one = materialise(one.repartitionByRange(n, "path").sortWithinPartitions("path").withColumn("rank", F.monotonically_increasing_id()).drop("path"), "chat-sorted")
    step = one.select("rank", F.posexplode(F.transform("turns", lambda t: F.struct(t["node"].alias("node"), t["n_tokens"].alias("n_tokens")))).alias("depth", "t")).select("rank", "depth", "t.*")
    nodes = step.groupBy("node").agg(F.min("rank").alias("owner"), F.min("depth").alias("depth"), F.min("n_tokens").alias("n_tokens"))
    nodes = nodes.withColumn("_part", F.shiftright("owner", 33))
    run = Window.partitionBy("_part").orderBy("owner", "depth").rowsBetween(Window.unboundedPreceding, -1)
    sums = nodes.groupBy("_part").agg(F.sum("n_tokens").alias("_n"))  # a row for each range
    sums = sums.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    placed = nodes.withColumn("_run", F.coalesce(F.sum("n_tokens").over(run), F.lit(0))).join(sums, F.col("_part") == F.col("_p"))
    placed = materialise(placed.select("node", "owner", (F.col("_ahead") + F.col("_run")).alias("place")), "chat-placed")
    way = step.join(placed, "node").groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("depth", "owner", "place", "n_tokens"))).alias("way"))
    way = one.select("rank", "turns").join(way, "rank")

    def run_way(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for via, turns, way_ in zip(*(b.column(c).to_pylist() for c in ("rank", "turns", "way")), strict=True):
                seen: list[tuple[int, int]] = []
                position = 0
                for t, w in zip(turns, way_, strict=True):
                    if w["owner"] == via:
                        rows.append((t["node"], w["place"], t["n_tokens"], position, [{"start": x, "end": y} for x, y in seen], t["formatted"], t["loss_start"], t["loss_end"]))
                    position += w["n_tokens"]
                    seen = _append(seen, w["place"], w["place"] + w["n_tokens"])
            c = list(zip(*rows, strict=True)) or [()] * 8
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds, strict=True)], ["node", "place", "n_tokens", "position_id", "attends", "formatted", "loss_start", "loss_end"])

    full = in_arrow(way, run_way, "node binary, place long, n_tokens int, position_id long, attends array<struct<start:bigint,end:bigint>>, formatted string, loss_start int, loss_end int")
    leaves = convs.select("conv_id", "leaf", F.size("turns").cast("long").alias("n_turns"))
    full.route = one.select("leaf", F.posexplode(F.transform("turns", lambda t: t["node"])).alias("depth", "node"))
    return full, leaves


def read_back(nodes: DataFrame, leaves: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, from the packed nodes alone: each
    distinct conversation is put together from its nodes in order of place, and parsed."""
    d = nodes.route.join(nodes.select("node", "place", "formatted", "loss_start", "loss_end"), "node")
    d = d.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "place", "formatted", "loss_start", "loss_end"))).alias("way"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for way in b.column("way").to_pylist():
                turns = parse("".join(w["formatted"] for w in way))
                loss = "".join(unescape(w["formatted"][w["loss_start"] : w["loss_end"]]) for w in way)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                digest = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                for c, v in zip(cols, (len(turns), digest(said), len(loss), digest(loss), sum(len(w["formatted"]) for w in way)), strict=True):
                    c.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("leaf"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    done = in_arrow(d, run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return leaves.select("conv_id", "leaf").join(done, "leaf").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
