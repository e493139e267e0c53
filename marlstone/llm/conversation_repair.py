"""Repair of broken conversations by a suffix-shared automaton of their signatures.

A conversation's signature has one symbol a row: its role's class and its first
fault. All different signatures are read from the end, sorted by that reading and
dealt out in ranges. Rows with the same rest of a signature then stand at the same
state of one acyclic automaton, and a state has one way out, its own symbol. So what
the rest of a repair costs from a state, and the edits that reach it, depend on the
state and on the state of the role grammar only: both are worked out once for each
pair of them, whichever and however many conversations pass (again for the states on
the border of two ranges).

The best edits of a suffix are kept as links from state to state, not as texts, so
that memory is one link a state of the longest signature. Ties never need the texts:
of two edits of one state the letters differ, and the lesser letter wins.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import stored, table

# White space, ends of sentences, faults' and edits' costs.
SPACE = " \t\n\x0b\x0c\r"
ENDINGS = [".", "!", "?"]
LEGAL = ["su", "ua", "au"]
REROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1

# The grammar (s?(ua)+)? by state: what a letter leads to, and the letter that
# an inserted or a reroled row has.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = ["u", "u", "a", "u"]
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

# Symbols: x must go; small letters are roles, capitals roles of truncated rows, and
# o any other role.
MUST_GO = "x"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows that are left, by crc32 of `conv_id:turn`.

    Of 20 remainders 0 drops a row, 1 empties its text, 2 takes out `.`, `!` and `?`,
    3 repeats the row and 4 makes its role user. NULL counts as one space.
    """
    key = F.concat(
        _spaced(F.col("conv_id")), F.lit(":"), _spaced(F.col("turn"))
    )
    kind = F.crc32(key.cast("binary")) % 20
    role, text = _spaced(F.col("role")), _spaced(F.col("text"))
    return (
        conversations.select(
            "conv_id",
            "turn",
            F.when(kind == 4, "user").otherwise(role).alias("role"),
            F.when(kind == 1, "")
            .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(
                F.when(kind == 0, F.array().cast("array<int>"))
                .when(kind == 3, F.array(F.lit(0), F.lit(1)))
                .otherwise(F.array(F.lit(0)))
            ).alias("copy"),
        )
    ).drop("copy")


def _spaced(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


# -- signatures ----------------------------------------------------------------

ORDER = ["conv", "known", "turn", "role", "h1", "h2"]


def _rows(turns: DataFrame, *more: Column) -> DataFrame:
    """What is needed of each row; its text only as hashes.

    Turns are ordered NULLs first; rows of one turn by role and hash of the text.
    """
    text = F.col("text")
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv"),
        F.col("turn").isNotNull().alias("known"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        _spaced(F.col("role")).alias("role"),
        _spaced(text).alias("text"),
    )
    last = F.rtrim("text", F.lit(SPACE))
    return rows.select(
        "conv",
        "known",
        "turn",
        "role",
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit("second"), "text").alias("h2"),
        (last == "").alias("blank"),
        (~F.right(last, F.lit(1)).isin(ENDINGS)).alias("truncated"),
        *more,
    )


PIECE = (
    "conv string, known boolean, turn long, signature string, first string, last string, "
    "blank long, duplicate long, truncated long, illegal long, turns long, "
    "least long, greatest long"
)


def _pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each conversation, or part of one, in a task's sorted rows."""
    now: dict | None = None
    before = None
    for frame in frames:
        done = []
        for conv, known, turn, role, h1, h2, blank, truncated, seen in zip(
            *(frame[c] for c in (*ORDER, "blank", "truncated", "seen")), strict=True
        ):
            initial = role[:1]
            if now is None or conv != now["conv"]:
                if now is not None:
                    done.append(now)
                now = {
                    "conv": conv, "known": known, "turn": turn, "signature": [],
                    "first": initial, "last": None, "blank": 0, "duplicate": 0,
                    "truncated": 0, "illegal": 0, "turns": 0, "least": None, "greatest": None,
                }
                before = None
            elif now["last"] + initial not in LEGAL:
                now["illegal"] += 1
            if known and (before is None or before[:2] != (known, turn)):
                now["turns"] += 1
                now["least"] = turn if now["least"] is None else now["least"]
                now["greatest"] = turn
            row = (known, turn, role, h1, h2)
            symbol = initial if initial in ("s", "u", "a") else "o"
            if blank:
                now["blank"] += 1
                symbol = MUST_GO
            elif seen or row == before:
                now["duplicate"] += 1
                symbol = MUST_GO
            elif truncated:
                now["truncated"] += 1
                symbol = symbol.upper()
            now["signature"].append(symbol)
            now["last"], before = initial, row
        if done:
            yield _framed(done)
    if now is not None:
        yield _framed([now])


def _framed(pieces: list[dict]) -> pd.DataFrame:
    for p in pieces:
        p["signature"] = "".join(p["signature"])
    frame = pd.DataFrame(pieces)
    for c in ("least", "greatest"):
        frame[c] = frame[c].astype("Int64")
    return frame


def signatures(turns: DataFrame) -> DataFrame:
    """A row for each conversation: conv, its counts, and its signature.

    Rows are dealt out by ranges of (conversation, turn), so that a conversation
    which holds a great share of all rows is spread over many tasks; its pieces meet
    in one row. Whether a row was seen before is found by counting (conversation,
    role, text), not by holding what a conversation said.
    """
    rows = _rows(turns)
    said = ["conv", "role", "h1", "h2"]
    again = (
        rows.groupBy(*said)
        .agg(F.min(F.struct("known", "turn")).alias("earliest"), F.count("*").alias("times"))
        .where("times > 1")
        .select(*(F.col(c).alias(f"a_{c}") for c in said), "earliest")
    )
    same = [F.col(c).eqNullSafe(F.col(f"a_{c}")) for c in said]
    found = (
        rows.join(again, same, "left")
        .withColumn(
            "seen",
            F.coalesce(F.col("earliest") < F.struct("known", "turn"), F.lit(False)),
        )
        .select(*ORDER, "blank", "truncated", "seen")
    )
    pieces = (
        found.repartitionByRange("conv", "known", "turn")
        .sortWithinPartitions(*ORDER)
        .mapInPandas(_pieces, PIECE)
    )
    joined = pieces.groupBy("conv").agg(
        F.array_sort(
            F.collect_list(F.struct("known", "turn", "signature", "first", "last"))
        ).alias("p"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )
    n = F.size("p")
    seams = F.zip_with(
        F.slice("p", F.lit(1), n - 1),
        F.slice("p", F.lit(2), n - 1),
        lambda a, b: F.concat(a["last"], b["first"]),
    )
    return joined.select(
        "conv",
        F.coalesce(F.col("greatest") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        (F.col("illegal") + F.size(F.filter(seams, lambda s: ~s.isin(LEGAL)))).alias("illegal"),
        F.concat_ws("", F.col("p")["signature"]).alias("signature"),
    )


# -- the automaton -------------------------------------------------------------


class Automaton:
    """States of the signatures read from the end, on the path to the newest one.

    `add` takes signatures in the order of their reversed texts and keeps the states
    they share with the one before. A state's costs to go, by grammar state, are kept
    as their least and what is above it. Few such differences exist, so what a symbol
    makes of them is looked up after the first time.
    """

    def __init__(self) -> None:
        start, edits = _end()
        self.read = ""
        self.above = [start]
        self.least = [0]
        self.edits = [edits]
        self.known: dict[tuple, tuple] = {}
        self.states = 1

    def add(self, reading: str) -> tuple[int, str]:
        """Cost and edits of the signature whose reversed text is `reading`."""
        shared = len(os.path.commonprefix([self.read, reading]))
        for kept in (self.above, self.least, self.edits):
            del kept[shared + 1 :]
        for symbol in reading[shared:]:
            step = (symbol, self.above[-1])
            if step not in self.known:
                self.known[step] = _before(*step)
            above, more, edits = self.known[step]
            self.above.append(above)
            self.least.append(self.least[-1] + more)
            self.edits.append(edits)
            self.states += 1
        self.read = reading
        return self.least[-1] + self.above[-1][0], self._audit()

    def _audit(self) -> str:
        at, state, letters = len(self.edits) - 1, 0, []
        while (edit := self.edits[at][state]) is not None:
            letter, state = edit
            letters.append(letter)
            at -= letter != "I"
        return "".join(letters)


def _end() -> tuple[tuple, tuple]:
    """Costs and edits behind the last row, by grammar state."""
    return _with_inserts([(0, None) if q in ENDS else (1 << 30, None) for q in range(4)])


def _before(symbol: str, after: tuple) -> tuple[tuple, int, tuple]:
    """Costs above their least, that least, and edits of the state before `symbol`."""
    truncated = LEFT_TRUNCATED if symbol.isupper() else 0
    role, best = symbol.lower(), []
    for q in range(4):
        options = [(DELETE + after[q], ("D", q))]
        if symbol != MUST_GO:
            if (q, role) in NEXT:
                to = NEXT[q, role]
                options.append((truncated + after[to], ("K", to)))
            to = NEXT[q, WANTED[q]]
            options.append((REROLE + truncated + after[to], ("R", to)))
        best.append(min(options))
    costs, edits = _with_inserts(best)
    least = min(costs)
    return tuple(c - least for c in costs), least, edits


def _with_inserts(best: list[tuple]) -> tuple[tuple, tuple]:
    """`best` where an inserted row before it is no better.

    Inserting leads to states 2 and 3 only, and from one to the other; two inserted
    rows in a loop are never better than none.
    """
    best = list(best)
    plain = list(best)
    for q in (2, 3, 0, 1):
        to = NEXT[q, WANTED[q]]
        ahead = plain[to] if q in (2, 3) else best[to]
        inserted = (INSERT + ahead[0], ("I", to))
        if inserted[0] < best[q][0] or (inserted[0] == best[q][0] and "I" < best[q][1][0]):
            best[q] = inserted
    return tuple(c for c, _ in best), tuple(e for _, e in best)


def _solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    automaton = Automaton()
    for frame in frames:
        found = [automaton.add(reading) for reading in frame["reading"]]
        yield pd.DataFrame(
            {
                "signature": [r[::-1] for r in frame["reading"]],
                "cost": [c for c, _ in found],
                "audit": [a for _, a in found],
            }
        )


def solutions(signed: DataFrame) -> DataFrame:
    """signature, cost, audit of every different signature."""
    return (
        signed.select(F.reverse("signature").alias("reading"))
        .distinct()
        .repartitionByRange("reading")
        .sortWithinPartitions("reading")
        .mapInPandas(_solve, "signature string, cost long, audit string")
    )


# -- conversations -------------------------------------------------------------


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit per conversation.

    `turns` has conv_id, turn, role, text; other columns are not looked at. NULL
    conv_id is a conversation of its own, NULL role and text count as one space, NULL
    turns come first. An empty or unknown role can be deleted or reroled, not kept.
    Rows that are wholly equal are duplicates of the first of them. No rows give none.
    """
    kind = turns.schema["conv_id"].dataType
    signed = stored(signatures(turns), "signatures")
    return signed.join(solutions(signed), "signature").select(
        F.col("conv").cast(kind).alias("conv_id"),
        *("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
    )


def _edited(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Repaired rows from sorted rows; each conversation's audit comes before them."""
    conv, audit, at, state, position = None, "", 0, 0, 0
    out: list[tuple] = []

    def inserts() -> None:
        nonlocal at, state, position
        while audit[at : at + 1] == "I":
            out.append((conv, position, "I", ROLES[WANTED[state]], ""))
            at, state, position = at + 1, NEXT[state, WANTED[state]], position + 1

    for frame in frames:
        for c, edits, role, text in zip(
            *(frame[c] for c in ("conv", "audit", "role", "text")), strict=True
        ):
            if edits is not None:
                inserts()
                conv, audit, at, state, position = c, edits, 0, 0, 0
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            role = ROLES[WANTED[state]] if edit == "R" else role
            out.append((conv, position, edit, role, text))
            state, position = NEXT[state, role[:1]], position + 1
        yield pd.DataFrame(out, columns=["conv", "position", "edit", "role", "text"])
        out.clear()
    inserts()
    if out:
        yield pd.DataFrame(out, columns=["conv", "position", "edit", "role", "text"])


def _repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Rows of a conversation stand in one partition, in order.

    A conversation's task reads its rows one after the other and keeps none, so its
    memory is that of an audit; its texts are shuffled once.
    """
    rows = _rows(turns, F.col("text")).drop("blank", "truncated")
    leading = audited.select(F.col("conv_id").cast("string").alias("conv"), "audit")
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(
        leading, allowMissingColumns=True
    )
    return (
        both.repartition("conv")
        .sortWithinPartitions("conv", F.col("audit").isNull(), *ORDER[1:])
        .select("conv", "audit", "role", "text")
        .mapInPandas(
            _edited, "conv string, position long, edit string, role string, text string"
        )
    )


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id, position, edit (K, R or I), role, text of the repaired conversations."""
    kind = turns.schema["conv_id"].dataType
    return _repaired(turns, audited).select(
        F.col("conv").cast(kind).alias("conv_id"), "position", "edit", "role", "text"
    )


def _digested(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, digest = None, None
    for frame in frames:
        out = []
        for c, position, role, text in zip(
            *(frame[c] for c in ("conv", "position", "role", "text")), strict=True
        ):
            if position == 0:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
    if digest is not None:
        yield pd.DataFrame([(conv, digest.hexdigest())], columns=["conv", "repaired_sha256"])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults, cheapest repair and digest of what it then says."""
    conversations = table(spark, sf_dir, "conversations")
    kind = conversations.schema["conv_id"].dataType
    turns = damage(conversations)
    audited = stored(audits(turns), "audits")
    digests = _repaired(turns, audited).mapInPandas(
        _digested, "conv string, repaired_sha256 string"
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = audited.withColumn("a", F.col("conv_id").cast("string")).drop("conv_id")
    every = conversations.select(F.col("conv_id").cast("string").alias("c")).distinct()
    return (
        every.join(found, F.col("c").eqNullSafe(F.col("a")), "left")
        .join(digests, F.col("c").eqNullSafe(F.col("conv")), "left")
        .select(
            F.col("c").cast(kind).alias("conv_id"),
            *(F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
        )
    )
