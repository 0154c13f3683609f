"""Repair of conversation structure by Four-Russians block tables.

A conversation's roles have to read ``(s?(ua)+)?`` (system first if at all, then user and assistant
in turn). Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only edit of a blank or
duplicate turn), Insert an empty turn 5; a truncated turn that stays costs 5 more.

What a turn means for the costs is one of nine symbols. What the turns from some place to the end
still cost is a vector over the four states (nothing kept, after system, after user, after
assistant); less its least entry, only a few dozen vectors occur. For each of them and each block
of ``BLOCK`` symbols a table holds the vector before the block and the cost added, so a
conversation is worked off backward, a block a lookup. Tracing goes forward: each block is
expanded backward from the vector kept at its end, then every turn takes the ASCII-least edit that
stays on a cheapest path. An edit fixes the next state, so that path spells the least audit.

Spread: turns are range partitioned by (conversation, turn), which cuts a long conversation into
many parts. A conversation that lies within a part and a piece is repaired on the spot. Others are
written as pieces of at most ``PIECE`` turns; a piece's effect on every vector is a table of a few
dozen numbers, so the vectors at the ends of pieces come from composing those, and a second pass
traces the pieces in order, one at a time in memory. That pass reads a conversation in one task,
as a SHA-256 over its whole text demands; nothing is gathered there but the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import keep

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Symbols of a block, turns of a piece and bytes of its texts.
BLOCK, PIECE, PIECE_BYTES = 4, 4096, 4 << 20
_BLANKS = " \t\n\x0b\x0c\r"

# States: 0 nothing kept, 1 after system, 2 after user, 3 after assistant. Symbols: 0 has to go,
# 1 to 4 a sound turn of initial s, u, a or another, 5 to 8 the same but truncated.
_N_STATES, _N_SYMBOLS = 4, 9
_NEXT = (2, 2, 3, 2)  # by an inserted or reroled turn
_ROLE = {2: "user", 3: "assistant"}
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # by a kept turn's initial
_END = (0, 10, 5, 0)
_TAIL = ("", "II", "I", "")


class Tables:
    """Normalised cost vectors, their transitions by symbol and by block, and the cheapest edits."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors, number = block, [_END], {_END: 0}
        step: list[list[tuple[int, int]]] = [[] for _ in range(_N_SYMBOLS)]
        edits: list[list[tuple[tuple[str, int], ...]]] = [[] for _ in range(_N_SYMBOLS)]
        at = 0
        while at < len(self.vectors):
            for symbol in range(_N_SYMBOLS):
                before, choice = self._before(symbol, self.vectors[at])
                least = min(before)
                plain = tuple(x - least for x in before)
                if plain not in number:
                    number[plain] = len(self.vectors)
                    self.vectors.append(plain)
                step[symbol].append((number[plain], least))
                edits[symbol].append(choice)
            at += 1
        self.edits = edits
        one = np.array(step, np.int64)
        self.to, self.cost = one[:, :, 0], one[:, :, 1]
        to, cost = self.to, self.cost
        for _ in range(block - 1):  # a symbol in front of every shorter block
            cost = np.concatenate([cost + self.cost[s][to] for s in range(_N_SYMBOLS)])
            to = np.concatenate([self.to[s][to] for s in range(_N_SYMBOLS)])
        self.block_to, self.block_cost = to, cost

    @staticmethod
    def _before(symbol: int, after: tuple[int, ...]) -> tuple[list[int], tuple[tuple[str, int], ...]]:
        """Costs before a turn for the costs after it, and per state the least edits and the state they lead to."""
        extra = TRUNCATED if symbol >= 5 else 0
        initial = "sua?"[(symbol - 1) % 4] if symbol else None

        def ways(state: int) -> list[tuple[int, str, int]]:
            out = [(DELETE + after[state], "D", state)]
            if initial:
                if initial in _KEPT[state]:
                    out.append((KEEP + extra + after[_KEPT[state][initial]], "K", _KEPT[state][initial]))
                out.append((REROLE + extra + after[_NEXT[state]], "R", _NEXT[state]))
            return out

        def paths(state: int) -> list[tuple[int, str, int]]:
            out = []
            for n in range(3):  # inserted turns; a third leads back to where one does
                out += [(INSERT * n + c, "I" * n + e, s) for c, e, s in ways(state)]
                state = _NEXT[state]
            return out

        best = [min(paths(state)) for state in range(_N_STATES)]  # least cost, then least letters
        return [c for c, _, _ in best], tuple((e, s) for _, e, s in best)

    def back(self, symbols: np.ndarray, vector: int) -> tuple[int, int, list[int]]:
        """Vector and cost before ``symbols``, and the vector at the end of each block."""
        codes, rest = self._codes(symbols)
        total, ends = 0, []
        for s in rest[::-1]:
            vector, total = int(self.to[s, vector]), total + int(self.cost[s, vector])
        for code in codes[::-1]:
            ends.append(vector)
            vector, total = int(self.block_to[code, vector]), total + int(self.block_cost[code, vector])
        return vector, total, ends[::-1]

    def back_all(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vector and cost before ``symbols`` for every vector after them."""
        codes, rest = self._codes(symbols)
        vector, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for s in rest[::-1]:
            total, vector = total + self.cost[s][vector], self.to[s][vector]
        for code in codes[::-1]:
            total, vector = total + self.block_cost[code][vector], self.block_to[code][vector]
        return vector, total

    def _codes(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        n = len(symbols) // self.block * self.block
        codes = symbols[:n].reshape(-1, self.block) @ (_N_SYMBOLS ** np.arange(self.block - 1, -1, -1))
        return codes.tolist(), symbols[n:].tolist()

    def trace(self, symbols: np.ndarray, state: int, vector: int) -> tuple[list[str], int]:
        """The least edits for each turn (inserted turns before its own letter) and the state after."""
        _, _, ends = self.back(symbols, vector)
        out: list[str] = []
        n = len(ends) * self.block
        for lo, end in [*zip(range(0, n, self.block), ends), (n, vector)]:
            own = symbols[lo : lo + self.block] if lo < n else symbols[n:]
            after = [end]
            for s in own[:0:-1]:  # expand the block backward
                after.append(int(self.to[s, after[-1]]))
            for s, v in zip(own, after[::-1]):
                letters, state = self.edits[s][v][state]
                out.append(letters)
        return out, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# -- damage and faults ------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after damage: conv_id, turn, role, text, copy and ``gone`` (rows that damage drops).

    Damage is told by crc32 of "conv_id:turn" modulo 20; nulls count as one space, in that text
    as in role and text. Dropped rows stay as markers with null role and text, so that no
    conversation is lost.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), kind.alias("kind"))
    rows = rows.select("conv_id", "turn", "kind", F.when(F.col("kind") == 0, F.lit(None)).when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("kind") == 0, F.lit(None)).when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(copies).alias("copy"), (F.col("kind") == 0).alias("gone"))


def plain(conversations: DataFrame) -> DataFrame:
    """Rows as they are, in the form of ``damaged``."""
    blank = F.lit(" ")
    return conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), F.lit(0).alias("copy"), F.lit(False).alias("gone"))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` with their first fault (1 blank, 2 duplicate, 3 truncated, else 0) and symbol.

    Rows of a conversation stand by turn (nulls first), rows of one turn by role, text and copy.
    """
    said = F.rtrim(F.col("text"), F.lit(_BLANKS))
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy"))
    fault = F.when(F.col("gone"), 0).when(said == "", 1).when(seen > 1, 2).when(~F.substring(said, -1, 1).isin(".", "!", "?"), 3).otherwise(0)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(4)
    return rows.withColumn("fault", fault.cast("int")).withColumn(
        "symbol", F.when(F.col("fault").isin(1, 2), 0).when(F.col("fault") == 3, initial + 4).otherwise(initial).cast("int"))


# -- repair -----------------------------------------------------------------------------------

_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RAW = "part int, piece long, seq long, turn long, role string, text string, gone boolean, fault int, symbol int"
_RESULT_SCHEMA = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
_RAW_SCHEMA = pa.schema([("part", pa.int32()), ("piece", pa.int64()), ("seq", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("gone", pa.bool_()), ("fault", pa.int32()), ("symbol", pa.int32())])
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Repair:
    """One conversation, fed piece by piece in order; holds counts, the audit and a running hash."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.cost, self.audit, self.sha, self.kept = conv_id, 0, 0, [], hashlib.sha256(), 0
        self.faults, self.illegal, self.before, self.turns, self.low, self.high = [0, 0, 0, 0], 0, None, 0, None, None

    def _say(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.kept else "") + role + ":" + text).encode())
        self.kept += 1

    def _insert(self, state: int) -> int:
        state = _NEXT[state]
        self._say(_ROLE[state], "")
        return state

    def feed(self, rows: list[tuple], vector: int) -> None:
        """``rows`` (turn, role, text, gone, fault, symbol) with the vector after the last of them."""
        rows = [r for r in rows if not r[3]]
        for turn, role, _, _, fault, _ in rows:
            self.faults[fault] += 1
            if self.before is not None:
                self.illegal += (self.before, role[:1]) not in _LEGAL
            self.before = role[:1]
            if turn is not None and turn != self.high:  # turns ascend
                self.turns, self.low, self.high = self.turns + 1, turn if self.low is None else self.low, turn
        edits, end = tables().trace(np.array([r[5] for r in rows], np.int64), self.state, vector)
        state = self.state
        for (_, role, text, _, fault, _), letters in zip(rows, edits):
            for x in letters:
                if x == "I":
                    state, self.cost = self._insert(state), self.cost + INSERT
                elif x == "D":
                    self.cost += DELETE
                else:
                    state = _KEPT[state][role[0]] if x == "K" else _NEXT[state]
                    self.cost += (REROLE if x == "R" else KEEP) + (TRUNCATED if fault == 3 else 0)
                    self._say(role if x == "K" else _ROLE[state], text)
            self.audit.append(letters)
        assert state == end
        self.state = state

    def result(self) -> tuple:
        for _ in _TAIL[self.state]:
            self.state, self.cost = self._insert(self.state), self.cost + INSERT
            self.audit.append("I")
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest())


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


_COLUMNS = ("conv_id", "turn", "role", "text", "gone", "fault", "symbol")


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that lie within this part and one piece; the others' rows as pieces.

    The part's first and last conversation may go on in its neighbours.
    """
    from pyspark import TaskContext

    part, schema = TaskContext.get().partitionId(), pa.schema([*_RESULT_SCHEMA, *_RAW_SCHEMA])
    held: list[tuple] = []
    state = {"conv": None, "open": False, "cut": True, "piece": 0, "seq": 0, "bytes": 0}
    blank = (None,) * len(_RAW_SCHEMA)

    def pieces() -> list[tuple]:
        out = []
        for r in held:
            out.append((state["conv"], *(None,) * (len(_RESULT_SCHEMA) - 1), part, state["piece"], state["seq"], *r))
            state["seq"] += 1
        state["piece"] += 1
        held.clear()
        state["bytes"] = 0
        return out

    def close(last: bool) -> list[tuple]:
        if state["cut"] or last:
            return pieces() if held else []
        done = _Repair(state["conv"])
        done.feed(held, 0)
        held.clear()
        state["bytes"] = 0
        return [(*done.result(), *blank)]

    for batch in batches:
        for block in W.blocks(batch, "text", PIECE_BYTES):
            out = []
            for conv, *row in zip(*(block.column(c).to_pylist() for c in _COLUMNS)):
                if not state["open"] or conv != state["conv"]:
                    if state["open"]:
                        out += close(False)
                        state["cut"] = False
                    state |= {"conv": conv, "open": True}
                held.append(tuple(row))
                state["bytes"] += len(row[2] or "")
                if len(held) >= PIECE or state["bytes"] >= PIECE_BYTES:
                    out += pieces()
                    state["cut"] = True
            if out:
                yield _batch(out, schema)
    if state["open"] and (out := close(True)):
        yield _batch(out, schema)


def _effects(pdf):
    """One row a piece: its effect on every vector."""
    out = pdf.iloc[:1][["conv_id", "part", "piece"]].copy()
    said = pdf[~pdf["gone"]].sort_values("seq")
    out["to"] = [tables().back_all(said["symbol"].to_numpy(np.int64))[0].tolist()]
    return out


def _ends(pdf):
    """Vector at the end of each piece of a conversation: from the last piece to the first."""
    pdf = pdf.sort_values(["part", "piece"])
    vector, ends = 0, []
    for to in pdf["to"][::-1]:
        ends.append(vector)
        vector = int(to[vector])
    out = pdf[["part", "piece"]].copy()
    out["vector"] = ends[::-1]
    return out


def _second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order, one in memory at a time."""
    now, place, held, vector = None, None, [], 0
    for batch in batches:
        for block in W.blocks(batch, "text", PIECE_BYTES):
            out = []
            for conv, part, piece, end, *row in zip(*(block.column(c).to_pylist() for c in ("conv_id", "part", "piece", "vector", *_COLUMNS[1:]))):
                if place != (part, piece):
                    if held:
                        now.feed(held, vector)
                    if now is None or now.conv_id != conv:
                        if now is not None:
                            out.append(now.result())
                        now = _Repair(conv)
                    place, held, vector = (part, piece), [], end
                held.append(tuple(row))
            if out:
                yield _batch(out, _RESULT_SCHEMA)
    if now is not None:
        now.feed(held, vector)
        yield _batch([now.result()], _RESULT_SCHEMA)


def repair(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per conv_id of ``rows`` (made by ``damaged`` or ``plain``): counts, cost, audit, hash.

    ``conv_id`` and ``turn`` are whole numbers; a null conv_id is a conversation of its own. Equal
    rows are duplicates of the first. A conversation without rows has zeros, an empty audit and
    the hash of no bytes. A role without a first letter can't be kept as it is.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    typed = rows.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))
    # a bounded start of the text: the range sample that reaches the driver stays small
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 32)]
    dealt = faults(typed).repartitionByRange(parts, *order).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "copy")
    first = keep(dealt.select(*_COLUMNS).mapInArrow(_first_pass, f"{_RESULT}, {_RAW}"), "repair")
    names = [f.name for f in _RESULT_SCHEMA]
    raw = first.where(F.col("part").isNotNull()).select("conv_id", *[f.name for f in _RAW_SCHEMA])
    effects = raw.select("conv_id", "part", "piece", "seq", "gone", "symbol").groupBy("part", "piece").applyInPandas(
        _effects, "conv_id long, part int, piece long, to array<int>")
    ends = effects.groupBy("conv_id").applyInPandas(_ends, "part int, piece long, vector int")
    traced = (raw.join(ends, ["part", "piece"]).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "part", "seq")
              .select("conv_id", "part", "piece", "vector", *_COLUMNS[1:]).mapInArrow(_second_pass, _RESULT))
    return first.where(F.col("part").isNull()).select(*names).unionByName(traced)

