"""Repair of conversations by cheapest edits, the least audit among equals by prefix doubling.

Rows are put in order once, by conversation and turn, in pieces of bounded size; a long conversation
runs over several. What a piece costs between any two states of the conversation is a small matrix, and
the matrices of a conversation's pieces give the cost to go behind each. With it a piece works out the
optimal arcs of its nodes (a row and a state). Nodes are ranked by the first letter of their audit, then
by two, four and more: a node's rank at a doubled length is that of its own rank and of the rank its
pointer finds, and pointers double with it. The ranks tell equal audits, and the doubled pointers give
the nodes of the least path.

States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 may end.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept, slices, tasks_find_package

ROLES = ("user", "assistant")
#: State after an initial (system, user, assistant, any other) from each state; -1 where it has no place.
AFTER = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
#: State after an inserted or changed row.
NEXT = np.array([2, 2, 3, 2])
ENDS = np.array([True, False, False, True])
LETTERS = DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
#: Pairs of initials that may stand side by side.
LEGAL = {(0, 1), (1, 2), (2, 1)}
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED = 5
FAR = 1 << 60
#: Rows of a piece.
PIECE = 1 << 17
#: What the costs of nodes rest on.
NODES = ["conv", "piece", "pos", "live", "cut", "initial"]


def _key(conv_id: str) -> Column:
    """A conversation's id as text, null apart from all others."""
    return F.coalesce(F.concat(F.lit("="), F.col(conv_id).cast("string")), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, copies`` after the damage that the rows' checksums choose."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fate = F.crc32(F.concat_ws(":", *names).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return rows.where(fate != 0).select(
        _key("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with their faults, equal ones as one with their number.

    Of them ``blank`` or ``duplicate`` ones must go; if one need not, the row is ``live``.
    """
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    same = kept(same.withColumn("mark", F.md5(F.col("text").cast("binary"))))
    seat = F.struct(F.col("turn").isNotNull().alias("some"), "turn")  # nulls first
    first = same.groupBy("conv", "role", "mark").agg(F.min(seat).alias("first"))
    again = ~F.col("first.turn").eqNullSafe(F.col("turn"))
    words = F.regexp_replace("text", r"[\x20\x09-\x0D]+$", "")
    blank, copies = words == "", F.col("copies")
    live = ~blank & ~again
    none = F.lit(0).cast("long")
    return same.join(first, ["conv", "role", "mark"]).select(
        *["conv", "turn", "role", "text", "mark", "copies"],
        live.alias("live"),
        (live & ~F.substring(words, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.when(blank, copies).otherwise(none).alias("blank"),
        F.when(blank, none).when(again, copies).otherwise(copies - 1).alias("duplicate"),
        # 0 to 2 for system, user and assistant, 3 for any other first letter or none
        F.coalesce(*[F.when(F.col("role").startswith(x), n) for n, x in enumerate("sua")], F.lit(3)).alias("initial"),
    )


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows with ``pos``, their place among all rows, and the ``piece`` they stand in."""
    keys = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]
    pieces = max(1, -(-rows.count() // PIECE))
    ordered = rows.repartitionByRange(pieces, *keys).sortWithinPartitions(*keys)
    ordered = kept(ordered.select("*", F.monotonically_increasing_id().alias("pos")).drop("mark"))
    return ordered.withColumn("piece", F.shiftrightunsigned("pos", 33))


class Piece:
    """A piece's conversations, their live rows, and the costs of nodes."""

    def __init__(self, frame: pd.DataFrame):
        frame = frame.sort_values("pos", kind="stable")
        head = frame["conv"].ne(frame["conv"].shift()).to_numpy()
        owner, live = np.cumsum(head) - 1, frame["live"].to_numpy(dtype=bool)
        self.number = int(frame["piece"].iloc[0])
        self.convs = frame["conv"].to_numpy()[head]
        self.last = frame["pos"].to_numpy()[np.append(head[1:], True)]
        self.pos = frame["pos"].to_numpy()[live]
        self.initial, self.cut = frame["initial"].to_numpy()[live], frame["cut"].to_numpy(dtype=bool)[live]
        self.count = np.bincount(owner[live], minlength=len(self.convs))
        self.begin = np.cumsum(self.count) - self.count

    def arcs(self, row: np.ndarray, go: np.ndarray) -> dict[str, np.ndarray]:
        """Costs by deleting, keeping and changing rows, given those to go behind them, by state."""
        late = (TRUNCATED * self.cut[row])[:, None]
        to = AFTER[:, self.initial[row]].T
        kept_ = np.take_along_axis(go, np.maximum(to, 0), axis=1) + late
        return {
            DELETE: COST[DELETE] + go,
            KEEP: COST[KEEP] + np.where(to < 0, FAR, kept_),
            REROLE: COST[REROLE] + late + go[:, NEXT],
        }

    @staticmethod
    def inserted(go: np.ndarray) -> np.ndarray:
        """Costs where rows may be inserted first."""
        user = np.minimum(go[:, 2], COST[INSERT] + go[:, 3])
        other = np.minimum(go[:, 3], COST[INSERT] + go[:, 2])
        begun = [np.minimum(go[:, state], COST[INSERT] + user) for state in (0, 1)]
        return np.minimum(np.column_stack([*begun, user, other]), FAR)

    def costs(self, go: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs to go from every conversation's first node and from every live row, by state.

        ``go`` are those behind the conversations' last rows, where inserts are counted already.
        """
        now, every = go.copy(), np.zeros((len(self.pos), 4), dtype=np.int64)
        order = np.argsort(-self.count, kind="stable")
        there = self.count[order]
        for step in range(1, int(there[0]) + 1 if len(there) else 0):
            own = order[: np.searchsorted(-there, -step, side="right")]
            row = self.begin[own] + self.count[own] - step
            every[row] = now[own] = self.inserted(np.minimum.reduce([*self.arcs(row, now[own]).values()]))
        return now, every


#: Costs behind the last row of a conversation.
AT_END = Piece.inserted(np.where(ENDS, 0, FAR)[None])[0]


def _matrices(rows: DataFrame) -> DataFrame:
    """``conv, piece, costs``: of a conversation's part in a piece, from any state to any other."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        piece = Piece(frame)
        found = np.zeros((len(piece.convs), 4, 4), dtype=np.int64)
        for end in range(4):
            go = np.full((len(piece.convs), 4), FAR)
            go[:, end] = 0
            found[:, :, end] = piece.costs(go)[0]
        costs = list(found.reshape(-1, 16))
        return pd.DataFrame({"conv": piece.convs, "piece": piece.number, "costs": costs})

    return rows.select(*NODES).groupBy("piece").applyInPandas(run, "conv string, piece long, costs array<long>")


def _long_ones(rows: DataFrame) -> DataFrame:
    """Rows of the conversations that have parts in several pieces."""
    ends = rows.groupBy("conv").agg(F.min("piece").alias("lo"), F.max("piece").alias("hi"))
    return rows.join(ends.where("lo < hi").select("conv"), "conv", "left_semi")


def _behind(matrices: DataFrame) -> DataFrame:
    """``piece, conv, go, starts, ends``: costs behind a part of a long conversation, and where it stands.

    A conversation has a matrix for each of its pieces, so few numbers however long it is.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("piece").reset_index(drop=True)
        go = [AT_END]
        for matrix in np.stack(frame["costs"]).reshape(-1, 4, 4)[:0:-1]:
            go.append(np.minimum((matrix + go[-1]).min(axis=1), FAR))
        return pd.DataFrame(
            {
                "piece": frame["piece"],
                "conv": frame["conv"],
                "go": go[::-1],
                "starts": frame.index == 0,
                "ends": frame.index == len(frame) - 1,
            }
        )

    schema = "piece long, conv string, go array<long>, starts boolean, ends boolean"
    return matrices.groupBy("conv").applyInPandas(run, schema)


class Ranks:
    """Ranks of nodes by audits of doubled lengths, and the pointers that double with them."""

    def __init__(self, letter: np.ndarray, target: np.ndarray):
        """``letter``: a node's least optimal one, 0 at an end; ``target``: where that arc leads."""
        self.letter, self.pointers, rank = letter, [target], letter
        while (letter[self.pointers[-1]] > 0).any():
            pointer = self.pointers[-1]
            _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
            self.pointers.append(pointer[pointer])
        self.rank = rank

    def paths(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of least paths, ends left out, and the starts they belong to."""
        nodes, owner = starts, np.arange(len(starts))
        for pointer in reversed(self.pointers):
            nodes, owner = np.column_stack([nodes, pointer[nodes]]).ravel(), np.repeat(owner, 2)
            there = self.letter[nodes] > 0
            nodes, owner = nodes[there], owner[there]
        return nodes, owner


def _ranked(piece: Piece, go: np.ndarray, ends: np.ndarray) -> Ranks:
    """Nodes are four states of every live row, then four behind each conversation's last.

    ``ends`` tells which conversations end here: elsewhere the next part inserts.
    """
    rows, convs = len(piece.pos), len(piece.convs)
    every = piece.costs(go)[1]
    now = np.concatenate([every, go])
    behind = np.arange(1, rows + 1)
    some = np.flatnonzero(piece.count)
    behind[piece.begin[some] + piece.count[some] - 1] = rows + some
    arcs = piece.arcs(np.arange(rows), now[behind])
    to = {DELETE: np.arange(4)[None], KEEP: np.maximum(AFTER[:, piece.initial].T, 0), REROLE: NEXT[None]}
    letter = np.zeros((rows + convs, 4), dtype=np.int64)
    target = np.arange(4 * (rows + convs)).reshape(-1, 4)
    node = 4 * np.arange(rows + convs)[:, None]
    may = np.append(np.ones(rows, dtype=bool), ends)[:, None] & (now < FAR)
    # no two arcs of a node share a letter, so the least letter that is optimal is its least arc
    for code, name in reversed([*enumerate(LETTERS, 1)]):
        if name == INSERT:
            fits, leads = may & (COST[INSERT] + now[:, NEXT] == now), node + NEXT
            letter[fits], target[fits] = code, leads[fits]
        else:
            fits, leads = (arcs[name] == every) & (every < FAR), 4 * behind[:, None] + to[name]
            letter[:rows][fits], target[:rows][fits] = code, np.broadcast_to(leads, fits.shape)[fits]
    return Ranks(letter.ravel(), target.ravel())


def _decisions(rows: DataFrame, behind: DataFrame) -> DataFrame:
    """``conv, piece, entry, exit, pos, kind, edits``: for live rows, and behind a part's last (kind 2).

    ``edits`` has a letter for each edit, a row's own after those inserted before it. A part that does
    not start its conversation is worked out for every state it may be entered in.
    """

    def run(frame: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        piece = Piece(frame)
        known = dict(zip(more["conv"], zip(more["go"], more["starts"], more["ends"])))
        parts = [known.get(conv, (AT_END, True, True)) for conv in piece.convs]
        go, begins, ends = (np.array(x) for x in zip(*parts))
        ranks = _ranked(piece, go, ends)
        conv = np.repeat(np.arange(len(begins)), np.where(begins, 1, 4))
        entry = np.arange(len(conv)) - np.searchsorted(conv, conv)
        first = np.where(piece.count > 0, piece.begin, len(piece.pos) + np.arange(len(begins)))
        starts = 4 * first[conv] + entry
        # equal ranks are equal audits, which are spelled out once
        _, one, audit = np.unique(ranks.rank[starts], return_index=True, return_inverse=True)
        nodes, owner = ranks.paths(starts[one])
        spelled = np.array(["", *LETTERS])[ranks.letter[nodes]]
        texts = ["".join(x) for x in np.split(spelled, np.searchsorted(owner, np.arange(1, len(one))))]
        edits = [[*re.findall("I*[DKR]", x), re.search("I*$", x)[0]] for x in texts]
        size = np.array([len(x) for x in edits])[audit]
        pos = [np.append(piece.pos[b : b + n], e) for b, n, e in zip(piece.begin, piece.count, piece.last)]
        # an entry that leads nowhere has no edits, only its end
        pos = [pos[c][-n:] for c, n in zip(conv, size)]
        return pd.DataFrame(
            {
                "conv": np.repeat(piece.convs[conv], size),
                "piece": piece.number,
                "entry": np.repeat(entry, size),
                "exit": np.repeat(ranks.pointers[-1][starts] % 4, size),
                "pos": np.concatenate(pos),
                "kind": np.concatenate([np.append(np.zeros(n - 1, dtype=np.int64), 2) for n in size]),
                "edits": [x for a in audit for x in edits[a]],
            }
        )

    schema = "conv string, piece long, entry int, exit int, pos long, kind int, edits string"
    pieces = rows.select(*NODES).groupBy("piece").cogroup(behind.groupBy("piece"))
    return pieces.applyInPandas(run, schema)


def _entered(decisions: DataFrame) -> DataFrame:
    """``conv, piece, entry``: the states in which the parts of long conversations are entered."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        to = {(p, e): x for p, e, x in zip(frame["piece"], frame["entry"], frame["exit"])}
        pieces, state, out = sorted(frame["piece"].unique()), 0, []
        for piece in pieces:
            out.append((frame["conv"].iloc[0], piece, state))
            state = to[piece, state]
        return pd.DataFrame(out, columns=["conv", "piece", "entry"])

    ends = decisions.where("kind = 2").select("conv", "piece", "entry", "exit")
    return ends.groupBy("conv").applyInPandas(run, "conv string, piece long, entry int")


class _Repaired:
    """A conversation as its rows and edits come by; of its text only the digest is held."""

    def __init__(self, conv: str):
        self.conv, self.state, self.cost, self.audit = conv, 0, 0, []
        self.digest, self.empty = hashlib.sha256(), True
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.least = self.turn = self.initial = None
        self.edits = ""

    def add(self, role: str, text: str) -> None:
        line = f"{role}:{text}"
        self.digest.update((line if self.empty else "\n" + line).encode())
        self.empty = False

    def insert(self, edits: str) -> None:
        for letter in edits:
            self.audit.append(letter)
            self.cost += COST[letter]
            if letter != INSERT:
                break
            self.state = int(NEXT[self.state])
            self.add(ROLES[self.state - 2], "")

    def row(self, turn, role, text, copies, blank, duplicate, live, cut, initial) -> None:
        if turn is not None and turn != self.turn:
            self.distinct += 1
            self.least = turn if self.least is None else self.least
            self.turn = turn
        if self.initial is not None and (self.initial, initial) not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # no role may follow itself
        self.initial = initial
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += cut
        if live:
            self.insert(self.edits)
            letter = self.edits[-1]
            if letter != DELETE:
                self.cost += TRUNCATED * cut
                self.state = int(AFTER[self.state, initial] if letter == KEEP else NEXT[self.state])
                self.add(role if letter == KEEP else ROLES[self.state - 2], text)
        self.audit.append(DELETE * (blank + duplicate))
        self.cost += COST[DELETE] * (blank + duplicate)

    def result(self) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.distinct
        counts = gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost
        return self.conv, *counts, "".join(self.audit), self.digest.hexdigest()


def _digests(rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """Results by ``conv``. The digest of a text is sequential, so a conversation streams through one task."""
    columns = ["turn", "role", "text", "copies", "blank", "duplicate", "live", "cut", "initial"]
    both = rows.select("conv", "pos", F.lit(1).alias("kind"), *columns).unionByName(
        decisions.select("conv", "pos", "kind", "edits"), allowMissingColumns=True
    )
    both = both.repartition("conv").sortWithinPartitions("conv", "pos", "kind")
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(done: list[tuple]) -> pa.RecordBatch:
            types = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.string()]
            names = ["conv", "gaps", *counts, "audit", "repaired_sha256"]
            arrays = [pa.array(x, type=t) for x, t in zip(zip(*done), types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
        now, done = None, []
        for batch in slices(batches, batch_text):
            for conv, _, kind, *row, edits in zip(*[c.to_pylist() for c in batch.columns]):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.result())
                    now = _Repaired(conv)
                if kind == 0:
                    now.edits = edits
                elif kind == 1:
                    now.row(*row)
                else:
                    now.insert(edits)
            if done:
                yield table(done)
                done = []
        if now is not None:
            yield table([now.result()])

    batch_text = both.columns.index("text")
    return both.mapInArrow(run, f"{schema}, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    One row for every ``conv_id`` of ``conversations`` rows, null among them, after the fixed damage.
    Null roles and texts are one space. Rows stand by turn, nulls first, those of one turn by role and
    the digest of the text; of equal rows all but the first are duplicates. A role without a first
    letter of system, user or assistant has no legal place. A conversation without rows after the damage
    has zeros, an empty audit and the digest of no text. An empty table gives none; further columns are
    ignored. No conversation is held whole but for its audit: pieces have about ``PIECE`` rows.
    """
    tasks_find_package(rows.sparkSession)
    ordered = _in_order(kept(_marked(damaged(rows))))
    long = kept(_long_ones(ordered))
    behind = kept(_behind(_matrices(long)))
    decisions = kept(_decisions(ordered, behind))
    split = decisions.join(behind.select("conv").distinct(), "conv", "left_semi")
    entered = kept(_entered(split))
    chosen = decisions.join(behind.select("conv").distinct(), "conv", "left_anti").unionByName(
        split.join(entered, ["conv", "piece", "entry"], "left_semi")
    )
    found = _digests(ordered, chosen)
    every = rows.select("conv_id").distinct().withColumn("conv", _key("conv_id"))
    zeros = {c: F.lit(0) for c in ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]}
    none = {**zeros, "audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    return every.join(found, "conv", "left").select(
        "conv_id", *[F.coalesce(F.col(c), x).alias(c) for c, x in none.items()]
    )
