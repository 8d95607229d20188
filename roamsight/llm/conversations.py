"""Repair of conversation structure: the cheapest edits, ties by prefix-doubling path ranking.

Roles have to read ``(s?(ua)+)?`` by their initials: perhaps a system turn, then user and assistant in turn, ending with the
assistant. Rows are kept (0), given another role (3), deleted (4; required for blank and repeated rows), and empty user or
assistant rows inserted (3); a truncated row that stays adds 3.

The choice is a cheapest path through nodes (row, what the last role was). A dynamic programme from the end gives every node
the cost still to come; arcs that lie on a cheapest path remain. Nodes are then ranked by the first one, two, four, eight ... letters
of the least audit (D, I, K, R) that leads to the end: the rank for twice the length is that of the pair of a node's rank and its
pointer's, and pointers double along. An arc is taken for its letter and the rank of the node it leads to; the doubled
pointers give the node at every place of the path at once.

One conversation may hold a third of all rows. Rows are sorted by ranges, so that it lies over many partitions, and cut into
blocks of at most ``ROWS`` rows. A block is a small matrix, the least cost from each state before it to each one after it; matrices
of a partition's blocks are multiplied, then those of the partitions, and what is still to come flows back the same way, so no
task gets more than one partition's blocks or one small matrix per partition. Repeated rows are found by grouped minima and
a join on row positions. Only the digest reads a conversation in one task, as a stream of blocks: SHA-256 has no other way.

Rows are ordered by turn (nulls first), equal turns by role and text. Null roles and texts are one space, so a null text is blank.
A null conversation id is a conversation of its own. Rows equal in all these columns stand next to each other, and all but the first
are duplicates. Roles other than system, user and assistant have to be changed or deleted. A conversation without rows needs no edit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roamsight.sources.staging import stage, unstage

ROWS = 512
CHARACTERS = 1 << 20
DELETE, RENAME, INSERT, TRUNCATED = 4, 3, 3, 3
SPACE = " \t\n\x0b\x0c\r"
_ROLES = {"u": "user", "a": "assistant"}
#: States: nothing yet, after system, after user, after assistant; _NEXT is the state after the role that is due.
_NEXT = np.array([2, 2, 3, 2])
_CODES = "suao"
_LETTERS = np.frombuffer(b"\0DIKR", np.uint8)
_FAR = 1 << 40  # more than any cost in a block


def code_of(role: str, fault: str | None) -> str:
    """One letter per row: b or d if it has to go, else the role's initial (o for others), a capital if truncated."""
    if fault in ("blank", "duplicate"):
        return fault[0]
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return initial.upper() if fault == "truncated" else initial


def _arcs(code: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Costs still to come (rows, state, ...) by deleting, inserting, keeping and renaming, given those after the row."""
    stays = code < 2 * len(_CODES)
    shape = (len(code), *[1] * (after.ndim - 1))
    extra = np.where(stays, np.where(code >= len(_CODES), TRUNCATED, 0), _FAR).reshape(shape)
    role = code % len(_CODES)
    fits = np.zeros((len(code), 4), bool)
    fits[:, 0] = stays & (role <= 1)
    fits[:, 1] = fits[:, 3] = stays & (role == 1)
    fits[:, 2] = stays & (role == 2)
    target = np.where((role == 0)[:, None], 1, _NEXT[None, :])
    more = tuple([1] * (after.ndim - 2))
    target = np.broadcast_to(target.reshape(*target.shape, *more), after.shape)
    keep = np.where(fits.reshape(*fits.shape, *more), np.take_along_axis(after, target, 1) + extra, _FAR)
    rename = np.minimum(after[:, _NEXT] + RENAME + extra, _FAR)
    delete = after + DELETE
    base = np.minimum(np.minimum(keep, rename), delete)
    insert = np.minimum(base[:, _NEXT] + INSERT, base[:, _NEXT[_NEXT]] + 2 * INSERT)
    return delete, insert, keep, rename


@dataclass
class Blocks:
    """Rows of many blocks in one array of codes; nodes of a block are numbered (row, state), with one more row for its end."""

    codes: np.ndarray
    first: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, codes: list[str]) -> Blocks:
        letters = np.frombuffer("".join(codes).encode(), np.uint8)
        numbers = np.full(128, 2 * len(_CODES), np.int64)
        for i, letter in enumerate(_CODES + _CODES.upper()):
            numbers[ord(letter)] = i
        sizes = np.array([len(c) for c in codes], np.int64)
        return cls(numbers[letters], np.cumsum(sizes) - sizes, sizes)

    def backwards(self, after: np.ndarray, seen: Callable | None = None) -> np.ndarray:
        """Costs still to come before each block from those after it; all blocks step back together."""
        order = np.argsort(-self.sizes, kind="stable")
        out = after.copy()
        for back in range(1, int(self.sizes.max(initial=0)) + 1):
            mine = order[: int(np.searchsorted(-self.sizes[order], -back, side="right"))]
            row = self.sizes[mine] - back
            delete, insert, keep, rename = _arcs(self.codes[self.first[mine] + row], out[mine])
            best = np.minimum(np.minimum(delete, insert), np.minimum(keep, rename))
            if seen:
                seen(mine, row, best, delete, insert, keep, rename)
            out[mine] = best
        return out

    def matrices(self) -> np.ndarray:
        """Least cost from each state before a block to each one after it."""
        unit = np.where(np.eye(4, dtype=bool), 0, _FAR)
        return np.minimum(self.backwards(np.repeat(unit[None], len(self.sizes), 0)), _FAR)

    def arcs(self, after: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each node's cheapest arcs lead, one column per letter and -1 for none, and each block's first node.

        The node after all others is the end; arcs without a letter lead from a block's end to it, in column 0.
        """
        rows = 4 * (self.sizes + 1)
        base = np.cumsum(rows) - rows
        end, states = int(rows.sum()), np.arange(4)
        arcs = np.full((end + 1, len(_LETTERS)), -1, np.int64)
        arcs[end, 0] = end
        closing = (base + 4 * self.sizes)[:, None] + states
        arcs[closing, 0] = end
        # behind the last row of a conversation an answer, or a question and an answer, may be missing
        for state in (1, 2):
            arcs[closing[last, state], 0], arcs[closing[last, state], 2] = -1, closing[last, _NEXT[state]]

        def seen(mine, row, best, *costs) -> None:
            node = (base[mine] + 4 * row)[:, None] + states
            role = self.codes[self.first[mine] + row] % len(_CODES)
            due = node - states + _NEXT
            kept = np.where((role == 0)[:, None], node - states + 1, due)
            for letter, (cost, to) in enumerate(zip(costs, (node + 4, due, kept + 4, due + 4), strict=True), 1):
                arcs[node, letter] = np.where(cost == best, to, -1)

        self.backwards(after, seen)
        return arcs, base

    def audits(self, after: np.ndarray, last: np.ndarray, states: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """The least cheapest audit from the given states before each block (a row per block), and the states after it."""
        arcs, base = self.arcs(after, last)
        end, there = len(arcs) - 1, arcs >= 0
        letter = there.argmax(1)
        jumps = doubled(np.take_along_axis(arcs, letter[:, None], 1)[:, 0], end)
        rank = letter
        for to in jumps[:-1]:
            rank = np.unique(rank * (rank.max() + 1) + rank[to], return_inverse=True)[1]
        # with the ranks of whole audits known, an arc's audit is its letter and the rank of where it leads
        whole = np.where(there, np.arange(len(_LETTERS)) * (rank.max() + 1) + rank[arcs], np.iinfo(np.int64).max)
        letter = whole.argmin(1)
        pointer = np.take_along_axis(arcs, letter[:, None], 1)[:, 0]
        if (pointer != jumps[0]).any():
            jumps = doubled(pointer, end)
        sizes = (letter > 0).astype(np.int64)
        for to in jumps[:-1]:
            sizes = sizes + sizes[to]
        starts = (base[:, None] + states).ravel()
        sizes = sizes[starts]
        owner = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        node = starts[owner]
        for k, to in enumerate(jumps):
            node = np.where(place >> k & 1, to[node], node)
        text = _LETTERS[letter[node]].tobytes()
        ends = np.cumsum(sizes).tolist()
        at = starts
        for to in reversed(jumps):  # the last node before the end
            at = np.where(to[at] == end, at, to[at])
        states_after = at % 4
        return [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], states_after.reshape(states.shape)


def doubled(pointer: np.ndarray, end: int) -> list[np.ndarray]:
    """Where 1, 2, 4, ... steps lead, until all are at the end."""
    jumps = [pointer]
    while (jumps[-1] != end).any():
        jumps.append(jumps[-1][jumps[-1]])
    return jumps


AT_END = np.array([0, 2 * INSERT, INSERT, 0])


def damage(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows of a conversation table with the faults that the hash of their place draws: (conv_id, turn, role, text)."""
    as_text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    drawn = F.crc32(F.concat(as_text(id_col), F.lit(":"), as_text(turn_col)).cast("binary")) % 20
    rows = df.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), as_text(role_col).alias("role"), as_text(text_col).alias("text"), drawn.alias("drawn")
    ).where("drawn <> 0")
    text = F.when(F.col("drawn") == 1, "").when(F.col("drawn") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("drawn") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("drawn") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumns({"text": text, "role": role, "again": F.explode(times)}).select("conv_id", "turn", "role", "text")


_BLOCK = "key string, part int, seq int, roles array<string>, texts array<string>, codes string"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows as blocks. Further copies of a row follow it without text, as they have to go."""
    from pyspark import TaskContext

    part, seq, key, size = TaskContext.get().partitionId(), 0, None, 0
    roles: list[str] = []
    texts: list[str] = []
    codes: list[str] = []

    def flush() -> pa.RecordBatch:
        row = {"key": [key], "part": [part], "seq": [seq], "roles": [list(roles)], "texts": [list(texts)], "codes": ["".join(codes)]}
        for held in (roles, texts, codes):
            held.clear()
        types = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row.values(), types, strict=True)], list(row))

    for batch in batches:
        for row in batch.to_pylist():
            for copy in range(row["copies"]):
                if codes and (row["key"] != key or len(codes) >= ROWS or size >= CHARACTERS):
                    yield flush()
                    seq, size = seq + 1, 0
                key = row["key"]
                fault = row["fault"] if not copy or row["fault"] == "blank" else "duplicate"
                roles.append(row["role"])
                code = code_of(row["role"], fault)
                texts.append("" if code in "bd" else row["text"])
                codes.append(code)
                size += len(texts[-1])
    if codes:
        yield flush()


def blocks_of(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text), described and cut into staged blocks: ``codes`` has b and d for blank and duplicate rows."""
    plain = lambda name: F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    rows = df.select(plain("conv_id").alias("key"), "turn", plain("turn").alias("at"), space("role").alias("role"), space("text").alias("text"))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("said", said).groupBy("key", "at", "said").agg(
        F.min("turn").alias("turn"), F.min("role").alias("role"), F.min("text").alias("text"), F.count("*").alias("copies")
    )
    rows = stage(rows, "turns")
    position = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "at")
    earliest = rows.groupBy("key", "said").agg(F.min(position).alias("first")).select("key", "said", F.col("first.at").alias("at"))
    rows = rows.join(earliest.withColumn("first", F.lit(True)), ["key", "at", "said"], "left")
    trimmed = F.rtrim("text", F.lit(SPACE))
    fault = F.when(trimmed == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), "truncated")
    rows = rows.select("key", "turn", "role", "text", "copies", fault.alias("fault"))
    order = ["key", F.asc_nulls_first("turn"), "role", "text"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("key", "role", "text", "copies", "fault")
    return stage(rows.mapInArrow(_cut, _BLOCK), "blocks")


def _lists(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _scanned(values: DataFrame, product: Callable, running: Callable, kind: str) -> DataFrame:
    """A scan over the blocks of each conversation in two levels: (key, part, seq, value) with each block's value.

    ``product`` folds a list of small arrays into one; ``running`` turns a list and what comes from outside into one value
    per entry. Lists have a partition's blocks of one conversation, or one entry per partition.
    """

    @F.arrow_udf("array<bigint>")
    def fold(lists: pa.Array) -> pa.Array:
        return pa.array([product(one).ravel().tolist() for one in lists.to_pylist()], pa.list_(pa.int64()))

    @F.arrow_udf(f"array<{kind}>")
    def spread(lists: pa.Array, outside: pa.Array) -> pa.Array:
        found = [running(one, start) for one, start in zip(lists.to_pylist(), outside.to_pylist(), strict=True)]
        return pa.array(found, pa.list_(pa.list_(pa.int64()) if kind.startswith("array") else pa.int64()))

    listed = lambda number: F.array_sort(F.collect_list(F.struct(F.col(number).alias("number"), "value"))).alias("list")
    parts = values.groupBy("key", "part").agg(listed("seq"))
    parts = stage(parts.withColumn("value", fold("list.value")), "parts")
    whole = parts.groupBy("key").agg(listed("part"))
    none = F.lit(None).cast(kind)
    whole = whole.select("key", F.explode(F.arrays_zip(F.col("list.number").alias("part"), spread("list.value", none).alias("start"))).alias("one"))
    parts = parts.select("key", "part", "list").join(whole.select("key", "one.part", "one.start"), ["key", "part"])
    spreading = F.arrays_zip(F.col("list.number").alias("seq"), spread("list.value", "start").alias("value"))
    return parts.select("key", "part", F.explode(spreading).alias("one")).select("key", "part", "one.seq", "one.value")


def _multiplied(matrices: list) -> np.ndarray:
    out = np.array(matrices[0]).reshape(4, 4)
    for matrix in matrices[1:]:
        out = np.minimum((out[:, :, None] + np.array(matrix).reshape(4, 4)[None]).min(1), _FAR)
    return out


def _to_come(matrices: list, after: list | None) -> list[list[int]]:
    """Costs still to come after each of the matrices."""
    found = [np.array(AT_END if after is None else after)]
    for matrix in reversed(matrices[1:]):
        found.append((np.array(matrix).reshape(4, 4) + found[-1][None]).min(1))
    return [f.tolist() for f in reversed(found)]


def _composed(maps: list) -> np.ndarray:
    out = np.arange(4)
    for one in maps:
        out = np.array(one)[out]
    return out


def _entered(maps: list, before: int | None) -> list[int]:
    """State before each of the maps."""
    found = [before or 0]
    for one in maps[:-1]:
        found.append(one[found[-1]])
    return found


def audited(blocks: DataFrame) -> DataFrame:
    """Blocks with ``audit``, their piece of the conversation's least cheapest audit."""

    every = np.arange(4)

    def solved(codes: pa.Array, after: pa.Array, last: pa.Array, states: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        blocks = Blocks.of(codes.to_pylist())
        return blocks.audits(_lists(after).reshape(-1, 4), last.to_numpy(zero_copy_only=False), states)

    @F.arrow_udf("array<bigint>")
    def matrix(codes: pa.Array) -> pa.Array:
        found = Blocks.of(codes.to_pylist()).matrices()
        return pa.array(found.reshape(len(codes), 16).tolist(), pa.list_(pa.int64()))

    @F.arrow_udf("array<bigint>")
    def leads(codes: pa.Array, after: pa.Array, last: pa.Array) -> pa.Array:
        found = solved(codes, after, last, np.tile(every, (len(codes), 1)))[1] if len(codes) else np.zeros((0, 4))
        return pa.array(found.tolist(), pa.list_(pa.int64()))

    @F.arrow_udf("string")
    def piece(codes: pa.Array, after: pa.Array, last: pa.Array, state: pa.Array) -> pa.Array:
        found = solved(codes, after, last, state.to_numpy().reshape(-1, 1))[0] if len(codes) else []
        return pa.array([f.decode() for f in found], pa.string())

    at_end = F.array(*[F.lit(int(c)).cast("bigint") for c in AT_END])
    place = F.struct("part", "seq")
    long = blocks.groupBy("key").agg(F.count("*").alias("n"), F.max(place).alias("last")).where("n > 1").select("key", "last")
    cut = blocks.select("key", "part", "seq", "codes").join(long, "key")
    cut = stage(cut.select("key", "part", "seq", "codes", (place == F.col("last")).alias("last")), "long")
    to_come = _scanned(cut.withColumn("value", matrix("codes")), _multiplied, _to_come, "array<bigint>")
    known = cut.join(to_come.withColumnRenamed("value", "after"), ["key", "part", "seq"])
    known = stage(known, "to_come")
    states = _scanned(known.withColumn("value", leads("codes", "after", "last")), _composed, _entered, "bigint")
    known = known.drop("codes").join(states.withColumnRenamed("value", "state"), ["key", "part", "seq"])
    joined = blocks.join(known, ["key", "part", "seq"], "left")
    last, after, state = F.coalesce("last", F.lit(True)), F.coalesce("after", at_end), F.coalesce("state", F.lit(0).cast("bigint"))
    return joined.select(*blocks.columns, piece("codes", after, last, state).alias("audit"))


def edits(roles: list[str], texts: list[str], audit: str, state: int) -> Iterator[tuple[str, int | None, str, str]]:
    """(edit, row number, role, text) of each letter of an audit; deleted rows have their old role."""
    at = 0
    for letter in audit:
        due = "a" if state == 2 else "u"
        if letter == "I":
            yield letter, None, _ROLES[due], ""
        else:
            yield letter, at, _ROLES[due] if letter == "R" else roles[at], texts[at]
            due = "s" if letter == "K" and roles[at][:1] == "s" else due
            at += 1
        if letter != "D":
            state = {"s": 1, "u": 2, "a": 3}[due]


def after_audit(roles: list[str], audit: str, state: int) -> int:
    for edit, _, role, _ in edits(roles, roles, audit, state):
        if edit != "D":
            state = {"s": 1, "u": 2, "a": 3}[role[:1]]
    return state


_REPAIRED = "key string, part int, seq int, place int, edit string, role string, text string"


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks in order, with the state before them."""
    key, state = None, 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            if row["key"] != key:
                key, state = row["key"], 0
            row["state"] = state
            yield row
            state = after_audit(row["roles"], row["audit"], state)


def repaired_rows(blocks: DataFrame) -> DataFrame:
    """Every edit with the row it leaves: deleted rows have the edit D and stay visible; filter them for the repaired table."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "part", "seq", "place", "edit", "role", "text"]
        types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
        for row in _streamed(batches):
            found = [
                (row["key"], row["part"], row["seq"], n, edit, role, text)
                for n, (edit, _, role, text) in enumerate(edits(row["roles"], row["texts"], row["audit"], row["state"]))
            ]
            columns = zip(*found, strict=True) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    return _ordered(blocks).mapInArrow(emit, _REPAIRED)


def _ordered(blocks: DataFrame) -> DataFrame:
    return blocks.repartition("key").sortWithinPartitions("key", "part", "seq")


_REPORT = "key string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its blocks in order."""
    key, found, digest, pieces, role_before, empty = None, None, None, [], None, True

    def flush() -> pa.RecordBatch:
        row = {"key": key, **found, "audit": "".join(pieces), "repaired_sha256": digest.hexdigest()}
        types = [pa.string(), *[pa.int64()] * 5, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row))

    for row in _streamed(batches):
        if found is None or row["key"] != key:
            if found is not None:
                yield flush()
            key, digest, pieces, role_before, empty = row["key"], hashlib.sha256(), [], None, True
            found = dict.fromkeys(["blank", "duplicate", "truncated", "illegal", "cost"], 0)
        codes, audit = row["codes"], row["audit"]
        found["blank"] += codes.count("b")
        found["duplicate"] += codes.count("d")
        found["truncated"] += sum(c.isupper() for c in codes)
        for role in row["roles"]:
            if role_before is not None and role_before + role[:1] not in ("su", "ua", "au"):
                found["illegal"] += 1
            role_before = role[:1]
        found["cost"] += DELETE * audit.count("D") + INSERT * audit.count("I") + RENAME * audit.count("R")
        pieces.append(audit)
        for edit, at, role, text in edits(row["roles"], row["texts"], audit, row["state"]):
            if edit != "D":
                if at is not None and codes[at].isupper():
                    found["cost"] += TRUNCATED
                digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
                empty = False
    if found is not None:
        yield flush()


def report(df: DataFrame, conversations: Column | DataFrame | None = None) -> DataFrame:
    """Faults, cost, audit and digest of every conversation of df (conv_id, turn, role, text).

    ``conversations`` (conv_id) names those to report; without it these are the ones that have rows.
    """
    named = (df if conversations is None else conversations).select("conv_id").distinct()
    blocks = blocks_of(df)
    found = _ordered(audited(blocks)).mapInArrow(_digested, _REPORT)
    turns = df.where(F.col("turn").isNotNull()).select("conv_id", F.col("turn").cast("decimal(20,0)").alias("turn")).distinct()
    gaps = F.expr("try_cast(max(turn) - min(turn) + 1 - count(turn) as bigint)")
    turns = turns.groupBy("conv_id").agg(gaps.alias("gaps"), F.lit(True).alias("counted"))
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    out = named.withColumn("key", key).join(turns.select(key.alias("key"), "gaps", "counted"), "key", "left").join(found, "key", "left")
    zero = lambda name: F.coalesce(name, F.lit(0).cast("bigint")).alias(name)
    nothing = hashlib.sha256().hexdigest()
    return out.select(
        "conv_id",
        F.when(F.col("counted"), F.col("gaps")).otherwise(F.lit(0).cast("bigint")).alias("gaps"),
        *map(zero, ["blank", "duplicate", "truncated", "illegal", "cost"]),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
