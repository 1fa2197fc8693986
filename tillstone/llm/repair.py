"""Conversation structure repair with Four-Russians block tables.

A conversation's roles should read (s?(ua)+)?: nothing, or an optional system
turn and then user and assistant in turn. Each row is one of nine symbols (its
role's initial and whether it is cut off, or a row that must go). What the rest
of a conversation costs from each of the four states of that pattern is a
vector; less its least entry it is one of a few dozen, so the step from the
vector behind a block of symbols to the one before it is a table entry. The
table of all blocks of a fixed length is built once per worker by joining
single steps.

Conversations are cut into chunks of rows, each chunk one string of symbols.
One pass goes through the chunks from the last to the first, a block per
look-up, and leaves the vector behind each chunk. A second one goes forward,
expands each block backward from the vector behind it, and takes the least
letter that still reaches the least cost, so ties fall to the ASCII-least edits.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstone.llm.common import Scratch
from tillstone.llm.sequences import numbered

SYMBOLS = "xsuaoSUAO"  # x must go; initials of whole rows (o: any other), then of rows that are cut off
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
# states: nothing yet, after system, after user, after assistant
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
WANTED = ("u", "u", "a", "u")
CHUNK = 1024
LENGTH = 4
NONE = hashlib.sha256(b"").hexdigest()
_FAR = 1 << 40


def _options(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may become of a row in a state."""
    found = [("D", DELETE, state)]
    if symbol != "x":
        role, extra = symbol.lower(), CUT_OFF if symbol.isupper() else 0
        if role == WANTED[state]:
            found.append(("K", KEEP + extra, NEXT[state]))
        elif role == "s" and state == START:
            found.append(("K", KEEP + extra, SYSTEM))
        found.append(("R", REROLE + extra, NEXT[state]))
    return found


def _step(symbol: str, state: int, after: tuple[int, ...]) -> tuple[int, str, int]:
    """Least cost, ASCII-least letters and next state of one row, inserts before it included."""
    best, at, inserts = (_FAR, "", state), state, 0
    while inserts < 3:
        for letter, cost, then in _options(symbol, at):
            best = min(best, (inserts * INSERT + cost + after[then], "I" * inserts + letter, then))
        at, inserts = NEXT[at], inserts + 1
    return best


class Tables(NamedTuple):
    vectors: list[tuple[int, ...]]
    one: np.ndarray  # [vector, symbol]: vector before it
    one_cost: np.ndarray  # and what its least entry is above the one behind
    many: np.ndarray  # the same for blocks of `length` symbols
    many_cost: np.ndarray
    length: int
    letters: list[list[list[tuple[str, int]]]]  # [vector behind][symbol][state]: letters, next state
    end: int


@lru_cache(maxsize=4)
def tables(length: int = LENGTH) -> Tables:
    """All cost vectors that occur, and the steps between them for single symbols and for blocks."""
    first = (0, 2 * INSERT, INSERT, 0)  # at the end: the inserts that are still due
    vectors, at, rows, costs, letters = [first], {first: 0}, [], [], []
    for after in vectors:  # grows while it is walked
        row, cost, chosen = [], [], []
        for symbol in SYMBOLS:
            best = [_step(symbol, state, after) for state in range(4)]
            least = min(b[0] for b in best)
            before = tuple(b[0] - least for b in best)
            if before not in at:
                at[before] = len(vectors)
                vectors.append(before)
            row.append(at[before])
            cost.append(least)
            chosen.append([(b[1], b[2]) for b in best])
        rows.append(row)
        costs.append(cost)
        letters.append(chosen)
    one, one_cost = np.array(rows, np.int32), np.array(costs, np.int64)
    many, many_cost = one, one_cost
    for _ in range(length - 1):  # put one symbol more before every block
        longer = one[many].transpose(0, 2, 1)
        longer_cost = (many_cost[:, :, None] + one_cost[many]).transpose(0, 2, 1)
        many, many_cost = longer.reshape(len(vectors), -1), longer_cost.reshape(len(vectors), -1)
    return Tables(vectors, one, one_cost, many, many_cost, length, letters, 0)


def _codes(symbols: str) -> np.ndarray:
    lookup = np.zeros(128, np.int64)
    lookup[[ord(c) for c in SYMBOLS]] = range(len(SYMBOLS))
    return lookup[np.frombuffer(symbols.encode(), np.uint8)]


def _blocks(codes: np.ndarray, length: int) -> tuple[int, list[int]]:
    """How many symbols precede the whole blocks, and the number of each block."""
    lead = len(codes) % length
    powers = len(SYMBOLS) ** np.arange(length - 1, -1, -1)
    return lead, (codes[lead:].reshape(-1, length) @ powers).tolist()


def back(symbols: str, behind: int, table: Tables) -> tuple[int, int, list[int]]:
    """Vector before the symbols, the cost added, and the vectors behind each block, from the last block to the first."""
    codes = _codes(symbols)
    lead, blocks = _blocks(codes, table.length)
    vector, cost, seen = behind, 0, []
    for block in reversed(blocks):
        seen.append(vector)
        cost += int(table.many_cost[vector, block])
        vector = int(table.many[vector, block])
    seen.append(vector)
    for code in codes[:lead][::-1].tolist():
        cost += int(table.one_cost[vector, code])
        vector = int(table.one[vector, code])
    return vector, cost, seen


def trace(symbols: str, behind: int, state: int, table: Tables) -> tuple[list[str], int]:
    """The letters for each row (its inserts first) and the state after them."""
    codes = _codes(symbols).tolist()
    lead = len(codes) % table.length
    _, _, seen = back(symbols, behind, table)
    out, at = [], 0
    for size in [lead] * (lead > 0) + [table.length] * (len(codes) // table.length):
        vector = seen[-1] if at == 0 and lead else seen[(len(codes) - at) // table.length - 1]
        expanded = []
        for code in reversed(codes[at : at + size]):
            expanded.append((vector, code))
            vector = int(table.one[vector, code])
        for v, code in reversed(expanded):
            letters, state = table.letters[v][code][state]
            out.append(letters)
        at += size
    return out, state


def _backward(length: int):
    def run(batches):
        table = tables(length)
        conv, vector, cost, started = None, table.end, 0, False
        for batch in batches:
            behind, costs, last = [], [], []
            for key, symbols in zip(batch.column("conv").to_pylist(), batch.column("symbols").to_pylist()):
                last.append(not started or key != conv)
                if last[-1]:
                    conv, vector, cost, started = key, table.end, 0, True
                behind.append(vector)
                vector, more, _ = back(symbols, vector, table)
                cost += more
                costs.append(cost + table.vectors[vector][START])  # the whole cost once the first chunk is reached
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(behind, pa.int32()), pa.array(costs, pa.int64()), pa.array(last, pa.bool_())],
                names=[*batch.schema.names, "behind", "cost", "last"],
            )

    return run


_EDIT = T.StructType(
    [
        T.StructField("place", T.LongType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("letter", T.StringType()),
        T.StructField("role", T.StringType()),
    ]
)


def _edits(symbols: str, letters: list[str], state: int, place: int) -> tuple[list[dict], int]:
    """The rows that the letters leave or put in, and the state after them; K takes the row as it is."""
    found = []
    for symbol, row in zip([*symbols, ""], letters):  # inserts at the very end belong to no row
        for seq, letter in enumerate(row):
            if letter == "D":
                continue
            kept_system = letter == "K" and symbol.lower() == "s"
            role = None if letter == "K" else "user" if WANTED[state] == "u" else "assistant"
            found.append({"place": place, "seq": seq, "letter": letter, "role": role})
            state = SYSTEM if kept_system else NEXT[state]
        place += 1
    return found, state


def _forward(length: int):
    arrow = pa.list_(pa.struct([("place", pa.int64()), ("seq", pa.int32()), ("letter", pa.string()), ("role", pa.string())]))

    def run(batches):
        table = tables(length)
        state = START
        for batch in batches:
            audits, edits = [], []
            for row in batch.select(["chunk", "first", "symbols", "behind", "last"]).to_pylist():
                if row["chunk"] == 0:
                    state = START
                letters, after = trace(row["symbols"], row["behind"], state, table)
                if row["last"]:
                    letters.append("I" * (0, 2, 1, 0)[after])
                found, state = _edits(row["symbols"], letters, state, row["first"])
                audits.append("".join(letters))
                edits.append(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(audits, pa.string()), pa.array(edits, arrow)],
                names=[*batch.schema.names, "audit", "edits"],
            )

    return run


def _hashes(batches):
    """One SHA-256 per conversation over its rows in order, a row at a time."""
    conv, digest = None, None
    for batch in batches:
        keys, values = [], []
        for key, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
            if digest is None or key != conv:
                if digest is not None:
                    keys.append(conv)
                    values.append(digest.hexdigest())
                conv, digest = key, hashlib.sha256(line.encode())
            else:
                digest.update(b"\n" + line.encode())
        if keys:
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field("conv").type), pa.array(values, pa.string())], names=["conv", "sha"]
            )
        kind = batch.schema.field("conv").type
    if digest is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array([digest.hexdigest()], pa.string())], names=["conv", "sha"]
        )


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as the contract spoils them: by crc32 of "conv_id:turn" modulo 20.

    0 drops a row, 1 empties its text, 2 takes . ! ? out of it, 3 repeats the row, 4 makes its role user. Nulls count
    as one space, in the hashed key, the role and the text; a null turn stays null.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % 20
    text = F.when(case == 1, "").when(case == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    copies = F.when(case == 3, 2).otherwise(1)
    return (
        conversations.filter(case != 0)
        .select(
            "conv_id",
            "turn",
            F.when(case == 4, "user").otherwise(filled("role")).alias("role"),
            text.alias("text"),
            F.explode(F.sequence(F.lit(1), copies)).alias("copy"),
        )
        .drop("copy")
    )


class Repair:
    """Faults and cheapest repair of every conversation of a table.

    Rows go by turn, null first; rows of one turn by role and text. Nulls in role and text count as one space, an empty
    role fits nowhere, and a null conversation id is a conversation. ``chunk`` is the number of rows in one string of symbols, ``length`` that of
    symbols in a block. Long conversations pass through a task as strings of a byte a row, and their texts, for the
    hash of the repaired text alone, one row at a time; nothing of a conversation is gathered but its audit.
    """

    def __init__(
        self,
        turns: DataFrame,
        conv_col: str = "conv_id",
        turn_col: str = "turn",
        role_col: str = "role",
        text_col: str = "text",
        chunk: int = CHUNK,
        length: int = LENGTH,
    ):
        self.conv_col, self.scratch = conv_col, Scratch(turns.sparkSession, "repair")
        self.conv_type = turns.schema[conv_col].dataType
        filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
        rows = turns.select(
            F.col(conv_col).alias("conv"),
            F.col(turn_col).alias("turn"),
            filled(role_col).alias("role"),
            filled(text_col).alias("text"),
        )
        self.rows = self.scratch.store(numbered(rows, "conv", "turn", ["role", "text"]), "rows")
        self.chunks = self._chunks(chunk, length)

    def faults(self) -> DataFrame:
        """conv, place, turn, initial and fault ('blank', 'duplicate', 'truncated' or null) of every row."""
        blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
        cut_off = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
        marked = self.rows.select(
            "conv",
            "place",
            "turn",
            F.substring("role", 1, 1).alias("initial"),
            F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("said"),
            F.when(blank, "blank").when(cut_off, "truncated").alias("own"),
        )
        firsts = marked.groupBy(F.col("conv").alias("of"), F.col("said").alias("what")).agg(F.min("place").alias("at"))
        joined = marked.join(firsts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("said") == F.col("what")))
        again = (F.col("place") > F.col("at")) & F.coalesce(F.col("own") != "blank", F.lit(True))
        return joined.select("conv", "place", "turn", "initial", F.when(again, "duplicate").otherwise(F.col("own")).alias("fault"))

    def _chunks(self, chunk: int, length: int) -> DataFrame:
        number = F.floor((F.col("place") - 1) / chunk).cast("long")
        # the last row of a chunk also leads the next one, for what is told by two rows side by side
        led = self.faults().withColumn(
            "chunk", F.explode(F.when(F.col("place") % chunk == 0, F.array(number, number + 1)).otherwise(F.array(number)))
        )
        order = Window.partitionBy("conv", "chunk").orderBy("place")
        pair = F.concat(F.lag("initial").over(order), "initial")
        role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
        symbol = (
            F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
        )
        told = led.select(
            "conv",
            "chunk",
            "place",
            "turn",
            "fault",
            symbol.alias("symbol"),
            F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
            F.coalesce(F.lag("turn").over(order) != F.col("turn"), F.col("turn").isNotNull()).alias("fresh"),
        ).filter(number == F.col("chunk"))
        symbols = F.array_sort(F.collect_list(F.struct("place", "symbol")))  # at most `chunk` of them
        strings = told.groupBy("conv", "chunk").agg(
            F.min("place").alias("first"),
            F.array_join(F.transform(symbols, lambda x: x["symbol"]), "").alias("symbols"),
            F.min("turn").alias("least"),
            F.max("turn").alias("most"),
            F.count_if("fresh").alias("turns"),
            *[F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")],
            F.count_if("illegal").alias("illegal"),
        )
        strings = self.scratch.store(strings, "strings")
        costed = T.StructType(
            [
                *strings.schema.fields,
                T.StructField("behind", T.IntegerType()),
                T.StructField("cost", T.LongType()),
                T.StructField("last", T.BooleanType()),
            ]
        )
        ordered = strings.repartition("conv").sortWithinPartitions("conv", F.desc("chunk"))
        backward = self.scratch.store(ordered.mapInArrow(_backward(length), costed), "backward")
        self.scratch.drop("strings")
        traced = T.StructType(
            [*costed.fields, T.StructField("audit", T.StringType()), T.StructField("edits", T.ArrayType(_EDIT))]
        )
        ordered = backward.repartition("conv").sortWithinPartitions("conv", "chunk")
        done = self.scratch.store(ordered.mapInArrow(_forward(length), traced), "edits")
        self.scratch.drop("backward")
        return done

    def turns(self) -> DataFrame:
        """The repaired rows: conv, place (of the row, or of the one that an insert precedes), seq, letter, role, text."""
        edits = self.chunks.select(F.col("conv").alias("of"), F.explode("edits").alias("e")).select("of", "e.*")
        edits = edits.select("of", F.col("place").alias("at"), "seq", "letter", F.col("role").alias("new_role"))
        rows = self.rows.select("conv", "place", "role", "text")
        joined = edits.join(rows, F.col("of").eqNullSafe(F.col("conv")) & (F.col("at") == F.col("place")), "left")
        return joined.select(
            F.col("of").alias("conv"),
            F.col("at").alias("place"),
            "seq",
            "letter",
            F.coalesce("new_role", "role").alias("role"),
            F.when(F.col("letter") == "I", "").otherwise(F.col("text")).alias("text"),
        )

    def report(self) -> DataFrame:
        """One row per conversation that has rows: gaps, faults, cost, audit and the hash of the repaired text."""
        chunks = F.array_sort(F.collect_list(F.struct("chunk", "audit")))
        found = self.chunks.groupBy("conv").agg(
            F.coalesce(F.max("most") - F.min("least") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
            F.max(F.when(F.col("chunk") == 0, F.col("cost"))).alias("cost"),
            F.array_join(F.transform(chunks, lambda x: x["audit"]), "").alias("audit"),
        )
        lines = self.turns().select("conv", "place", "seq", F.concat("role", F.lit(":"), "text").alias("line"))
        ordered = lines.repartition("conv").sortWithinPartitions("conv", "place", "seq")
        schema = T.StructType([T.StructField("conv", self.conv_type), T.StructField("sha", T.StringType())])
        hashes = ordered.select("conv", "line").mapInArrow(_hashes, schema).select(F.col("conv").alias("of"), "sha")
        whole = found.join(hashes, F.col("conv").eqNullSafe(F.col("of")), "left")
        return whole.select(
            F.col("conv").alias(self.conv_col),
            *[c for c in found.columns if c != "conv"],
            F.coalesce("sha", F.lit(NONE)).alias("repaired_sha256"),
        )


def repaired_conversations(original: DataFrame, turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``Repair(turns).report()`` for every id of ``original``; an id without rows in ``turns`` has zeros and no edits."""
    report = Repair(turns, conv_col=id_col).report()
    counts = [c for c in report.columns if c not in (id_col, "audit", "repaired_sha256")]
    ids = original.select(F.col(id_col).alias("_of")).distinct()
    joined = ids.join(report, F.col("_of").eqNullSafe(F.col(id_col)), "left")
    return joined.select(
        F.col("_of").alias(id_col),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(NONE)).alias("repaired_sha256"),
    )
