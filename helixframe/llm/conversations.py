"""Conversation structure repair by secondary-sorted streaming.

Rows are dealt by conversation and sorted by turn inside each partition, so a task reads one conversation after the other
and never holds one. The cheapest repair is a shortest path over four states (nothing yet, system, user, assistant was
last); the state that ``mapInPandas`` carries from one Arrow batch into the next is four costs, four running hashes of
the repaired text, and the order of the four edit scripts. Per row, three bytes say for each state where it came from;
beyond ``SPILL_BYTES`` a conversation's bytes go to an unnamed spill file of the task, and the script is read back from
its end. Scripts of equal cost are compared without reading them: what differs earlier decides, so the order of four
scripts and the last edits give the next order.

Whether a row repeats an earlier one of its conversation is a window over (conversation, role, text), so no task holds
the rows seen.

Null roles and texts count as one space. A null turn comes first; rows of one turn are ordered by role and text. A null
conv_id is a conversation of its own. Roles count by their first code point; an empty role has none. Repeated rows are
duplicates. A conversation without rows left has zeros, an empty script and the hash of no bytes. An empty table gives no
rows. Other columns of the input are left out.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

SPILL_BYTES = 8 << 20
NONE, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ("u", "u", "a", "u")  # what may follow; a system turn only comes first
ROLE = {"u": "user", "a": "assistant"}
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 2, 1, 5, 5
OPS = "DKR"
LEGAL = frozenset(("su", "ua", "au"))
BLANKS = " \t\n\v\f\r"
COLUMNS = (
    "conv_id string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string,"
    "repaired_sha256 string"
)


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows with faults by the hash of conversation and turn.

    A dropped row stays as a mark of its conversation, without role and text.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind"))
    text = (
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    dropped = F.col("kind") == 0
    return rows.select(
        "conv_id", "turn", F.when(~dropped, F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(~dropped, text).alias("text"), dropped.alias("dropped"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


@cache
def moves(initial: str, must_go: bool, extra: int) -> list[tuple[int, int, int, str]]:
    """Cheapest edits of one row from each state to each other: source, target, cost, inserts and edit."""
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for source in range(4):
        state = source
        for inserts in range(3):
            offers = [("D", DELETE_COST, state)]
            if not must_go:
                needed = NEXT[state]
                target = USER if needed == "u" else ASSISTANT
                offers.append(("R", REROLE_COST + extra, target))
                if initial == needed:
                    offers.append(("K", extra, target))
                elif initial == "s" and state == NONE:
                    offers.append(("K", extra, SYSTEM))
                elif initial == "":
                    offers.append(("K", extra, state))
            for op, price, target in offers:
                offer = (price + INSERT_COST * inserts, "I" * inserts + op)
                found[source, target] = min(offer, found.get((source, target), offer))
            state = USER if NEXT[state] == "u" else ASSISTANT
    return [(source, target, *offer) for (source, target), offer in found.items()]


class Repair:
    """Cheapest repair of one conversation, fed row by row."""

    def __init__(self, conv_id, spill_bytes: int = SPILL_BYTES):
        self.conv_id = conv_id
        self.cost: list[int | None] = [0, None, None, None]
        self.order = [0, 0, 0, 0]
        self.hashes = [hashlib.sha256(), None, None, None]
        self.begun = [False] * 4
        self.steps = tempfile.SpooledTemporaryFile(max_size=spill_bytes)
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None
        self.low = self.high = self.turn = None
        self.turns = 0

    def place(self, turn) -> None:
        """Count a turn for the gaps; turns come in order."""
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
            self.turns += 1

    def row(self, turn, role: str, text: str, repeats: bool) -> None:
        self.place(turn)
        initial = role[:1]
        if self.before is not None and self.before + initial not in LEGAL:
            self.illegal += 1
        self.before = initial
        last = text.rstrip(BLANKS)[-1:]
        must_go, extra = False, 0
        if not last:
            self.blank += 1
            must_go = True
        elif repeats:
            self.duplicate += 1
            must_go = True
        elif last not in ".!?":
            self.truncated += 1
            extra = TRUNCATED_COST
        # Candidates per target state: cost, order of the script so far, edits, source state, inserts.
        best: list[tuple | None] = [None] * 4
        cost, order = self.cost, self.order
        for source, target, price, edits in moves(initial if initial in "uas" else "other", must_go, extra):
            if cost[source] is not None:
                offer = (cost[source] + price, order[source], edits, source)
                if best[target] is None or offer < best[target]:
                    best[target] = offer
        packed = 0
        hashes, begun = [None] * 4, [False] * 4
        for target, offer in enumerate(best):
            if offer is None:
                continue
            _, _, edits, source = offer
            inserts, op = len(edits) - 1, edits[-1]
            packed |= (source | inserts << 2 | OPS.index(op) << 4) << (6 * target)
            hashes[target], begun[target] = self._written(source, inserts, op, role, text)
        self.steps.write(packed.to_bytes(3, "little"))
        ranks = {key: i for i, key in enumerate(sorted({o[1:3] for o in best if o is not None}))}
        self.order = [0 if o is None else ranks[o[1:3]] for o in best]
        self.cost = [None if o is None else o[0] for o in best]
        self.hashes, self.begun = hashes, begun
        self.n += 1

    def _written(self, source: int, inserts: int, op: str, role: str, text: str):
        """Hash of the repaired rows after inserts and one edit."""
        digest, begun, state = self.hashes[source], self.begun[source], source
        lines = []
        for _ in range(inserts):
            lines.append(ROLE[NEXT[state]] + ":")
            state = USER if NEXT[state] == "u" else ASSISTANT
        if op == "K":
            lines.append(f"{role}:{text}")
        elif op == "R":
            lines.append(f"{ROLE[NEXT[state]]}:{text}")
        digest = digest.copy()
        if lines:
            digest.update((("\n" if begun else "") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
        return digest, begun or bool(lines)

    def done(self) -> tuple:
        """The row of this conversation."""
        ends = []
        for state in range(4):
            if self.cost[state] is not None:
                inserts = {NONE: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}[state]
                ends.append((self.cost[state] + INSERT_COST * inserts, self.order[state], "I" * inserts, state))
        cost, _, inserted, state = min(ends)
        digest, _ = self._written(state, len(inserted), "D", "", "")
        parts, left, at = [inserted], self.n, state
        while left:
            count = min(left, 1 << 18)
            left -= count
            self.steps.seek(3 * left)
            block = self.steps.read(3 * count)
            script = []
            for i in range(count - 1, -1, -1):
                one = int.from_bytes(block[3 * i : 3 * i + 3], "little") >> (6 * at)
                script.append(OPS[one >> 4 & 3] + "I" * (one >> 2 & 3))
                at = one & 3
            parts.append("".join(script))
        self.steps.close()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        audit = "".join(parts)[::-1] if self.n else inserted
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation of rows as ``damage`` returns them."""
    kind = dict(rows.dtypes)["conv_id"]
    same = Window.partitionBy("conv_id", F.xxhash64("role", "text"), "role", "text").orderBy(F.asc_nulls_first("turn"))
    marked = rows.withColumn("repeats", ~F.col("dropped") & (F.row_number().over(same) > 1))
    ordered = marked.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text", "repeats")
    # As text, ids and turns keep all digits beside nulls.
    ordered = ordered.withColumns({c: F.col(c).cast("string") for c in ("conv_id", "turn")})

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: Repair | None = None
        names = [c.split()[0] for c in COLUMNS.split(",")]
        for frame in frames:
            out = []
            columns = (frame[c].astype(object).where(frame[c].notna(), None) for c in ("conv_id", "turn", "role", "text", "dropped", "repeats"))
            for conv_id, turn, role, text, dropped, repeats in zip(*columns, strict=True):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        out.append(current.done())
                    current = Repair(conv_id)
                if not dropped:
                    current.row(None if turn is None else int(turn), role, text, repeats)
            if out:
                yield pd.DataFrame(out, columns=names)
        if current is not None:
            yield pd.DataFrame([current.done()], columns=names)

    done = ordered.mapInPandas(stream, COLUMNS)
    return done.withColumn("conv_id", F.col("conv_id").cast(kind))
