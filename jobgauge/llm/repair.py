"""Least-cost repair of the structure of conversations: an optional system turn, then user and assistant by turns.

Every row is kept, given another role or deleted, and empty turns may be inserted. The cheapest edits, ties by the least
audit text, are found by a Viterbi pass over four states, the last role written. Survivors, the best paths to each state,
are leaves of a tree of back-pointers with reference counts: what all survivors share is emitted and freed, and ties are
decided on the complete paths below that. Long conversations are cut into chunks, each solved from every state it may be
entered in; a pass over a few numbers per chunk then chooses among these.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobgauge.llm.numbering import numbered
from jobgauge.sources.scratch import written

#: Costs of the edits; a truncated turn that is not deleted costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a conversation that one task solves at once.
CHUNK_ROWS = 4096
#: Any character that is not ASCII white space.
INK = r"[^\x20\x09-\x0D]"

START, SYSTEM, USER, ASSISTANT = range(4)
_STATES = range(4)
_NOT_AFTER_USER = (START, SYSTEM, ASSISTANT)
#: Tokens of an audit: the edit's initial, and that of the role it writes.
_KEEP, _REROLE, _INSERT, _DROP = ({s: k + r for s, r in zip(_STATES, "-sua")} for k in "KRID")
#: What is inserted after the last row in each state, and its cost.
_TAIL = {START: ("", 0), SYSTEM: ("IuIa", 2 * INSERT), USER: ("Ia", INSERT), ASSISTANT: ("", 0)}
#: A path to state s is never best where one to state t costs less by more than this: what s can do, t can at that price.
_EMULATE = {
    START: (0, 0, INSERT, 0), SYSTEM: (2 * INSERT, 0, INSERT, 2 * INSERT), USER: (INSERT + DELETE, INSERT, 0, INSERT), ASSISTANT: (DELETE, 0, INSERT, 0),
}
#: Classes of rows: by role initial, and by fault.
CLASSES = "sua"
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"


class Node:
    """One edit on a path: `uses` counts the edits after it and the survivors that end in it."""

    __slots__ = ("before", "token", "uses")

    def __init__(self, before: Node | None, token: str) -> None:
        self.before, self.token, self.uses = before, token, 0
        if before is not None:
            before.uses += 1


class Survivors:
    """The cheapest paths from one state to each state, by the least audit among equal costs."""

    def __init__(self, entry: int) -> None:
        self.root = Node(None, "")
        self.cost: dict[int, int] = {entry: 0}
        self.leaf: dict[int, Node] = {entry: self.root}
        self.root.uses = 1

    def path(self, leaf: Node) -> list[str]:
        """The edits that are not emitted yet."""
        tokens = []
        while leaf is not self.root:
            tokens.append(leaf.token)
            leaf = leaf.before
        return tokens[::-1]

    def _better(self, a: tuple[int, Node, tuple[str, ...]], b: tuple[int, Node, tuple[str, ...]] | None) -> bool:
        if b is None or a[0] != b[0]:
            return b is None or a[0] < b[0]
        if a[1] is b[1]:
            return a[2] < b[2]
        return [*self.path(a[1]), *a[2]] < [*self.path(b[1]), *b[2]]

    def _arrivals(self) -> dict[int, tuple[int, Node, tuple[str, ...]]]:
        """The best path to each state after any inserts."""
        best = {s: (c, self.leaf[s], ()) for s, c in self.cost.items()}
        for after, states in ((USER, _NOT_AFTER_USER), (ASSISTANT, (USER,))):
            for s in states:
                if s in best:
                    cost, leaf, tokens = best[s]
                    found = (cost + INSERT, leaf, (*tokens, _INSERT[after]))
                    if self._better(found, best.get(after)):
                        best[after] = found
        return best

    def step(self, initial: int, must_delete: bool, truncated: bool) -> list[str]:
        """Take in a row; the edits that are certain from now on."""
        best: dict[int, tuple[int, Node, tuple[str, ...]]] = {}

        def offer(state: int, found: tuple[int, Node, tuple[str, ...]], cost: int, token: str) -> None:
            path = (found[0] + cost, found[1], (*found[2], token))
            if self._better(path, best.get(state)):
                best[state] = path

        extra = TRUNCATED if truncated else 0
        for s, found in self._arrivals().items():
            offer(s, found, DELETE, _DROP[START])
            if must_delete:
                continue
            to = ASSISTANT if s == USER else USER
            offer(to, found, REROLE + extra, _REROLE[to])
            if initial == to or (initial == SYSTEM and s == START):
                offer(initial, found, extra, _KEEP[initial])
        kept = [s for s in best if not any(best[s][0] > best[t][0] + _EMULATE[t][s] for t in best)]
        leaves = {}
        for s in kept:
            leaf = best[s][1]
            for token in best[s][2]:
                leaf = Node(leaf, token)
            leaf.uses += 1
            leaves[s] = leaf
        old, self.leaf, self.cost = self.leaf, leaves, {s: best[s][0] for s in kept}
        for leaf in old.values():
            self._release(leaf)
        return self._shared()

    def _release(self, leaf: Node) -> None:
        leaf.uses -= 1
        while not leaf.uses and leaf is not self.root:
            leaf = leaf.before
            leaf.uses -= 1

    def _shared(self) -> list[str]:
        """Emit and free the edits that all survivors share."""
        if self.root.uses != 1 or any(leaf is self.root for leaf in self.leaf.values()):
            return []
        nodes, leaf = [], next(iter(self.leaf.values()))
        while leaf is not self.root:
            nodes.append(leaf)
            leaf = leaf.before
        out, ends = [], set(map(id, self.leaf.values()))
        while nodes:
            node = nodes.pop()
            out.append(node.token)
            self.root, node.before, node.token = node, None, ""
            if node.uses != 1 or id(node) in ends:
                break
        return out


@dataclass(frozen=True)
class Repaired:
    """turns: conv_id, rank, part, edit, turn, role, text of the repaired rows, in the order of rank and part.
    edits: conv_id, rank and the edits at each row, deleted ones too. faults: every row with its first fault.
    summary: conv_id and counts, cost and audit, one row per conversation that has rows."""

    turns: DataFrame
    edits: DataFrame
    faults: DataFrame
    summary: DataFrame


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of `turns`, NULL role and text a blank, with faults by the CRC-32 of conv_id and turn.

    Of the remainders by 20: 0 drops a row, 1 empties its text, 2 removes marks that end sentences, 3 repeats the row, 4
    gives it the role user. A NULL conv_id or turn is a blank in the key and stays NULL. Other columns are left out.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(part("text"), "[.!?]", "")).otherwise(part("text"))
    rows = turns.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(part("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> Repaired:
    """The cheapest repair of every conversation of `turns` (conv_id, turn, role, text; other columns are ignored).

    Rows are taken by turn, then role and text, NULL first; a NULL role or text is a blank, rows with a NULL conv_id are one
    conversation. The first fault of a row counts: blank (no ink), duplicate (its role and text came earlier), truncated
    (its last ink is no mark that ends a sentence). Blank and duplicate rows are deleted. What remains is nothing, or an
    optional system turn and then pairs of user and assistant, told by the first letters of the roles. Audits list the
    initials of Keep, Rerole, Delete and Insert in order; of the cheapest repairs the least audit, by ASCII, is taken. Equal
    rows take part one after the other, and an empty table gives empty results.

    Rows are numbered over range partitions, so a conversation may hold any share of the rows: a task solves `chunk_rows` of
    them at once, with a tree of unresolved edits only, and chunks are chosen by 16 costs each.
    """
    blank = F.lit(" ")
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"), F.coalesce("text", blank).alias("text")
    )
    rows = numbered(rows, ["turn", "role", "text"], within=["conv_id"])
    faults = written(_faults(rows), "turn-faults")
    chunks = written(_solved(faults, chunk_rows), "turn-chunks")
    chosen = written(_chosen(chunks), "turn-paths")
    edits = _edits(chosen, chunk_rows)
    return Repaired(_repaired(edits, rows), edits, faults, _summary(faults, chunks, chosen))


def _faults(rows: DataFrame) -> DataFrame:
    """conv_id, rank, total, turn, initial (class of the role's first letter) and fault of every row, without texts."""
    first = F.substring("role", 1, 1)
    initial = F.coalesce(*[F.when(first == letter, state) for state, letter in enumerate(CLASSES, SYSTEM)], F.lit(START))
    slim = rows.select(
        "conv_id", "rank", "total", "turn", "role", F.md5("text").alias("of_text"), initial.alias("initial"),
        (~F.col("text").rlike(INK)).alias("no_ink"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    same = slim.groupBy("conv_id", "role", "of_text").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1")
    same = same.select(F.col("conv_id").alias("s_conv"), F.col("role").alias("s_role"), F.col("of_text").alias("s_text"), "first")
    equal = F.col("conv_id").eqNullSafe(F.col("s_conv")) & (F.col("role") == F.col("s_role")) & (F.col("of_text") == F.col("s_text"))
    fault = F.when(F.col("no_ink"), BLANK).when(F.col("rank") > F.col("first"), DUPLICATE).when(F.col("cut"), CUT)
    return slim.join(same, equal, "left").select("conv_id", "rank", "total", "turn", "initial", fault.alias("fault"))


def _solved(faults: DataFrame, chunk_rows: int) -> DataFrame:
    """One row per chunk: its ends and neighbours that are illegal, and per entry and exit state cost, order and path.

    `ordered` ranks the paths of an entry by their audits. A conversation's only chunk has just the final path, at 0.
    """
    kind = faults.schema["conv_id"].dataType.simpleString()
    chunked = faults.withColumn("chunk", F.call_function("div", F.col("rank"), F.lit(chunk_rows).cast("long")))
    dealt = chunked.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "rank")
    columns = ["conv_id", "chunk", "total", "initial", "fault"]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results, key, chunk = [], None, None
        for batch in batches:
            for conv, number, total, initial, fault in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (conv, number):
                    if chunk is not None:
                        results.append(chunk.result())
                    key, chunk = (conv, number), _Chunk(conv, number, total <= chunk_rows)
                chunk.add(initial, fault)
            if len(results) >= 256:
                yield pa.RecordBatch.from_pylist(results, schema)
                results = []
        if chunk is not None:
            results.append(chunk.result())
        if results:
            yield pa.RecordBatch.from_pylist(results, schema)

    numbers = pa.list_(pa.int64())
    schema = pa.schema([
        ("conv_id", _arrow(faults, "conv_id")), ("chunk", pa.int64()), ("alone", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()),
        ("illegal", pa.int64()), ("costs", numbers), ("ordered", numbers), ("paths", pa.list_(pa.string())),
    ])
    return dealt.select(columns).mapInArrow(
        solve,
        f"conv_id {kind}, chunk bigint, alone boolean, first bigint, last bigint, illegal bigint, "
        "costs array<bigint>, ordered array<bigint>, paths array<string>",
    )


def _arrow(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


class _Chunk:
    """The survivors of each state that a chunk may be entered in, and what is certain of their paths."""

    def __init__(self, conv: object, number: int, alone: bool) -> None:
        self.conv, self.number, self.alone = conv, number, alone
        self.ways = {entry: (Survivors(entry), []) for entry in (_STATES if number else (START,))}
        self.first = self.last = None
        self.illegal = 0

    def add(self, initial: int, fault: str | None) -> None:
        if self.last is None:
            self.first = initial
        else:
            self.illegal += not legal(self.last, initial)
        self.last = initial
        for survivors, certain in self.ways.values():
            certain += survivors.step(initial, fault in (BLANK, DUPLICATE), fault == CUT)

    def result(self) -> dict:
        costs, ordered, paths = [None] * 16, [None] * 16, [None] * 16
        for entry, (survivors, certain) in self.ways.items():
            ends = {s: "".join([*certain, *survivors.path(leaf)]) for s, leaf in survivors.leaf.items()}
            for place, s in enumerate(sorted(ends, key=ends.__getitem__)):
                costs[4 * entry + s], ordered[4 * entry + s], paths[4 * entry + s] = survivors.cost[s], place, ends[s]
        if self.alone:
            cost, path = min((costs[s] + _TAIL[s][1], paths[s] + _TAIL[s][0]) for s in _STATES if paths[s] is not None)
            costs, ordered, paths = [cost], [0], [path]
        return {
            "conv_id": self.conv, "chunk": self.number, "alone": self.alone, "first": self.first, "last": self.last,
            "illegal": self.illegal, "costs": costs, "ordered": ordered, "paths": paths,
        }


def legal(before: int, after: int) -> bool:
    return (before, after) in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def _chosen(chunks: DataFrame) -> DataFrame:
    """conv_id, chunk, cost and path: for each chunk of a conversation the path that the cheapest repair of all takes."""
    kind = chunks.schema["conv_id"].dataType.simpleString()
    alone = chunks.filter("alone").select("conv_id", "chunk", F.col("costs")[0].alias("cost"), F.col("paths")[0].alias("path"))

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("chunk")
        entries = list(frame[["costs", "ordered"]].itertuples(index=False))
        after = [_TAIL[s][1] for s in _STATES]
        exits = []
        for costs, ordered in reversed(entries):
            exits.append({})
            least = []
            for entry in _STATES:
                ways = [
                    (costs[4 * entry + s] + after[s], ordered[4 * entry + s], s)
                    for s in _STATES
                    if pd.notna(costs[4 * entry + s]) and after[s] is not None
                ]
                least.append(min(ways)[0] if ways else None)
                exits[-1][entry] = min(ways)[2] if ways else None
            after = least
        way, cost, at = [], [], START
        for (costs, _), taken in zip(entries, reversed(exits)):
            way.append(4 * at + taken[at])
            cost.append(int(costs[way[-1]]))
            at = taken[at]
        return pd.DataFrame({
            "conv_id": frame["conv_id"], "chunk": frame["chunk"], "way": way,
            "cost": [*cost[:-1], cost[-1] + _TAIL[at][1]], "tail": [*[""] * (len(way) - 1), _TAIL[at][0]],
        })

    cut = chunks.filter("NOT alone")
    ways = cut.select("conv_id", "chunk", "costs", "ordered").groupBy("conv_id").applyInPandas(
        choose, f"conv_id {kind}, chunk bigint, way int, cost bigint, tail string"
    ).select(F.col("conv_id").alias("w_conv"), F.col("chunk").alias("w_chunk"), "way", "cost", "tail")
    same = F.col("conv_id").eqNullSafe(F.col("w_conv")) & (F.col("chunk") == F.col("w_chunk"))
    paths = cut.join(ways, same).select("conv_id", "chunk", "cost", F.concat(F.get("paths", F.col("way")), "tail").alias("path"))
    return alone.unionByName(paths)


def _edits(chosen: DataFrame, chunk_rows: int) -> DataFrame:
    """conv_id, rank and edit: the tokens at each row, inserts before its own; those after the last row stand at its end."""
    by_row = F.regexp_extract_all("path", F.lit(r"(?:I.)*[DKR].(?:(?:I.)+\z)?|(?:I.)+\z"), 0)
    placed = chosen.select("conv_id", "chunk", F.posexplode(by_row).alias("at", "edit"))
    return placed.select("conv_id", (F.col("chunk") * chunk_rows + F.col("at")).alias("rank"), "edit")


def _repaired(edits: DataFrame, rows: DataFrame) -> DataFrame:
    own = rows.select(F.col("conv_id").alias("r_conv"), F.col("rank").alias("r_rank"), "turn", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("rank") == F.col("r_rank"))
    tokens = F.regexp_extract_all("edit", F.lit("[IKR]."), 0)
    written_rows = edits.filter("edit <> 'D-'").join(own, same).select(
        "conv_id", "rank", "turn", "role", "text", F.posexplode(tokens).alias("part", "token")
    )
    edit, by = F.substring("token", 1, 1), F.substring("token", 2, 1)
    inserted = edit == "I"
    return written_rows.select(
        "conv_id", "rank", "part", edit.alias("edit"), F.when(~inserted, F.col("turn")).alias("turn"),
        F.when(edit == "K", F.col("role")).when(by == "u", "user").otherwise("assistant").alias("role"),
        F.when(inserted, "").otherwise(F.col("text")).alias("text"),
    )


def _summary(faults: DataFrame, chunks: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, rows, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation that has rows."""
    number = lambda c: c.cast("decimal(20,0)")  # noqa: E731  the span of turns may be wider than a long
    gaps = number(F.max("turn")) - number(F.min("turn")) + 1 - F.count_distinct("turn")
    counted = [F.count_if(F.col("fault") == fault).alias(fault) for fault in (BLANK, DUPLICATE, CUT)]
    rows = faults.groupBy("conv_id").agg(F.count("*").alias("rows"), F.least(F.coalesce(gaps, number(F.lit(0))), number(F.lit(2**63 - 1))).cast("long").alias("gaps"), *counted)
    before = F.lag("last").over(Window.partitionBy("conv_id").orderBy("chunk"))
    legal_border = F.coalesce(*[F.when((F.col("before") == a) & (F.col("first") == b), 0) for a in _STATES for b in _STATES if legal(a, b)], F.lit(1))
    border = F.when(F.col("before").isNull(), 0).otherwise(legal_border)
    illegal = chunks.withColumn("before", before).groupBy(F.col("conv_id").alias("i_conv")).agg(F.sum(F.col("illegal") + border).alias("illegal"))
    pieces = F.sort_array(F.collect_list(F.struct("chunk", F.regexp_replace("path", "(.).", "$1").alias("audit"))))
    paths = chosen.groupBy(F.col("conv_id").alias("c_conv")).agg(
        F.sum("cost").alias("cost"), F.concat_ws("", F.transform(pieces, lambda piece: piece["audit"])).alias("audit")
    )
    joined = rows.join(illegal, F.col("conv_id").eqNullSafe(F.col("i_conv"))).join(paths, F.col("conv_id").eqNullSafe(F.col("c_conv")))
    return joined.drop("i_conv", "c_conv")


def turns_digest(turns: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of `role:text` of its repaired turns, joined by line feeds, read in order batch by batch."""
    import hashlib

    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", _arrow(turns, "conv_id")), ("sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, found = None, None, []
        for batch in batches:
            for conv, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if state is None or conv != key:
                    if state is not None:
                        found.append({"conv_id": key, "sha256": state.hexdigest()})
                    key, state = conv, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    state.update(f"\n{role}:{text}".encode())
            yield pa.RecordBatch.from_pylist(found, schema)
            found = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": key, "sha256": state.hexdigest()}], schema)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "rank", "part")
    return ordered.select("conv_id", "role", "text").mapInArrow(digest, f"conv_id {kind}, sha256 string")


def repair_report(turns: DataFrame, repaired: Repaired) -> DataFrame:
    """One row per conv_id of `turns`, the table before damage: the summary and the digest of its repaired turns.

    A conversation without rows, or with all of them deleted, has the digest of the empty text.
    """
    digests = turns_digest(repaired.turns).select(F.col("conv_id").alias("d_conv"), "sha256")
    summary = repaired.summary.withColumnRenamed("conv_id", "s_conv")
    every = turns.select("conv_id").distinct()
    joined = every.join(summary, F.col("conv_id").eqNullSafe(F.col("s_conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left"
    )
    counts = [F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("gaps", BLANK, DUPLICATE, CUT, "illegal", "cost")]
    nothing: Column = F.sha2(F.lit(""), 256)
    return joined.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256")
    )
