"""Conversation structure repair: faults, and the cheapest edits to a legal shape.

A conversation is legal when its roles' initials read ``s?(ua)+`` or it is
empty.  Rows may be kept, reroled, deleted or inserted (``lattice.py``); blank
and duplicate rows must go.

**Plan.**  Rows are placed in turn order by range parts and cut into pieces of
at most ``PIECE`` rows (and about ``PIECE`` * ``UNIT`` bytes), so a
conversation may hold any share of the rows.  A piece's shape is one short
text.  A conversation of one piece is solved at once; of a longer one, each
piece gives its 4 x 4 costs, two running minima over the pieces give every
piece its costs of entry and of leaving, and each piece is then solved by
itself.  Texts are left out of all this; they are joined to the kept rows by
row number at the end, put together piece by piece, and a long conversation's
pieces are fed to one sha256 in order (a digest is sequential by definition;
one piece is in memory at a time).

Defined cases: a null role, text, or part of the damage key reads as one
space; a null turn sorts first and counts in no gap; rows that tie in turn go
by role, then text (UTF-8 bytes); a null conversation id is a conversation of
its own; a role with another or no initial can be reroled or deleted, never
kept; equal rows are duplicates of the first; a conversation that lost every
row has zeros, an empty audit and the hash of the empty text; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalforge.llm import lattice
from portalforge.llm.common import stored
from portalforge.operators.ranking import running_totals

PIECE = 4096  # rows of a piece
UNIT = 256  # bytes of text that weigh as much as a row
TIE_PREFIX = 64  # characters of a tied text that cut the ranges

_BLANK = r"[\x20\x09-\x0D]"
_SOLVED = "cost long, walks array<struct<state:int,audit:string>>"


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies``, by the crc32 of ``conv_id:turn``."""
    def read(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(read("conv_id"), F.lit(":"), read("turn"))) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace(read("text"), "[.!?]", "")).otherwise(read("text")))
    return conversations.filter(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(read("role")).alias("role"), text.alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """Every row and copy with its piece, place and two-character code, without texts."""
    same = F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text").cast("binary"), 256)
    short = rows.select("row", "conv_id", "turn", "role", "copies", F.unhex(same).alias("same"),
                        F.octet_length("text").alias("bytes"), (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
                        F.col("text").rlike(rf"[.!?]{_BLANK}*\z").alias("ended"))
    # The earliest of equal rows, where there are several.
    first = short.groupBy("conv_id", "role", "same").agg(
        F.min(F.struct("turn", "row"))["row"].alias("first"), F.count("*").alias("times")).filter("times > 1")
    first = stored(first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("same").alias("s"), "first"), "repair-first")
    short = short.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                       & (F.col("same") == F.col("s")), "left").drop("c", "r", "s")
    # Texts order rows only where they tie in turn and role.
    ties = short.groupBy("conv_id", "turn", "role").agg(F.min("same").alias("a"), F.max("same").alias("b")).filter("a <> b")
    ties = stored(ties.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("role").alias("r")), "repair-ties")
    tied = rows.join(ties, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
                     & (F.col("role") == F.col("r")), "left_semi").select("row", F.col("text").alias("tie"))
    short = stored(short.join(stored(tied, "repair-tied"), "row", "left"), "repair-rows")

    weight = F.col("copies") + F.floor(F.col("bytes") / UNIT)
    splits = [F.col("turn"), F.col("role"), F.substring("tie", 1, TIE_PREFIX)]
    order = running_totals(short, group=["conv_id"], order=["turn", "role", "tie", "row"], weight=weight,
                           before="at", splits=splits)
    each = order.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    again = (F.col("copy") > 0) | (F.col("first").isNotNull() & (F.col("first") != F.col("row")))
    fault = F.when(F.col("blank"), "b").when(again, "d").when(~F.col("ended"), "t").otherwise(".")
    initial = F.substring("role", 1, 1)
    code = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"), fault)
    at = F.col("at") + F.col("copy")
    return each.select("conv_id", "turn", "row", at.alias("at"), F.floor(at / limit).alias("piece"), code.alias("code"))


@lru_cache(maxsize=1 << 14)
def _solve(shape: str, entry: tuple, leave: tuple, last: bool):
    return lattice.cheapest(shape, entry, leave, last)


def _solved(shapes: pd.Series, entries: pd.Series, leaves: pd.Series, lasts: pd.Series) -> pd.DataFrame:
    out = [_solve(s, tuple(map(int, e)), tuple(map(int, x)), bool(last))
           for s, e, x, last in zip(shapes, entries, leaves, lasts)]
    return pd.DataFrame({"cost": [c for c, _ in out],
                         "walks": [[None if w is None else {"state": w[0], "audit": w[1]} for w in walks] for _, walks in out]})


def _crossing_costs(shapes: pd.Series, lasts: pd.Series) -> pd.Series:
    return pd.Series([[c for q in range(4) for c in lattice.reach(s, q, bool(last))] for s, last in zip(shapes, lasts)])


def _potentials(series: pd.Series) -> pd.Series:
    """Per conversation the pieces' 16 costs in order -> per piece 4 costs of
    entry and 4 of leaving."""
    out = []
    for costs in series:
        costs = [list(map(int, c)) for c in costs]
        entry = [list(lattice.BEGIN)]
        for m in costs[:-1]:
            entry.append([min(lattice.FAR, min(entry[-1][q] + m[4 * q + r] for q in range(4))) for r in range(4)])
        leave = [list(lattice.FINISH)]
        for m in reversed(costs[1:]):
            leave.append([min(lattice.FAR, min(m[4 * q + r] + leave[-1][r] for r in range(4))) for q in range(4)])
        out.append([a + b for a, b in zip(entry, reversed(leave))])
    return pd.Series(out)


def _entered(series: pd.Series) -> pd.Series:
    """Per conversation the pieces' states after each state of entry (-1: no
    way) -> the state in which each piece is entered."""
    out = []
    for exits in series:
        state, states = lattice.NOTHING, []
        for by_state in exits:
            states.append(state)
            state = int(by_state[state])
        out.append(states)
    return pd.Series(out)


def _outputs(shapes: pd.Series, audits: pd.Series, states: pd.Series) -> pd.Series:
    return pd.Series([[{"row": r, "role": role} for r, role in lattice.output(s, a, int(q))]
                      for s, a, q in zip(shapes, audits, states)])


def _solve_pieces(pieces: DataFrame) -> DataFrame:
    """``pieces`` (conv_id, piece, shape, ...) with cost, audit and entry state."""
    count = pieces.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("piece").alias("end")).filter("n > 1")
    count = stored(count.select(F.col("conv_id").alias("c"), "end"), "repair-long")
    mine = F.col("conv_id").eqNullSafe(F.col("c"))
    begin, finish = [F.array(*[F.lit(c).cast("long") for c in ends]) for ends in (lattice.BEGIN, lattice.FINISH)]
    whole = pieces.join(count, mine, "left_anti").withColumns({"entry": begin, "leave": finish, "last": F.lit(True)})

    long = pieces.join(count, mine).withColumn("last", F.col("piece") == F.col("end")).drop("c", "end")
    crossing = F.pandas_udf(_crossing_costs, "array<long>")("shape", "last")
    lists = long.select("conv_id", "piece", crossing.alias("costs")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("piece", "costs"))).alias("p"))
    costs = F.pandas_udf(_potentials, "array<array<long>>")(F.transform("p", lambda x: x["costs"]))
    around = lists.select("conv_id", F.explode(F.arrays_zip(F.transform("p", lambda x: x["piece"]).alias("piece"), costs.alias("costs"))).alias("z"))
    around = around.select(F.col("conv_id").alias("c"), F.col("z.piece").alias("k"), F.slice("z.costs", 1, 4).alias("entry"),
                           F.slice("z.costs", 5, 4).alias("leave"))
    long = long.join(around, mine & (F.col("piece") == F.col("k"))).drop("c", "k")

    solver = F.pandas_udf(_solved, _SOLVED)("shape", "entry", "leave", "last")
    keep = [*pieces.columns, "solved"]
    whole = whole.withColumn("solved", solver).select(*keep).withColumn("state", F.lit(lattice.NOTHING))
    long = stored(long.withColumn("solved", solver).select(*keep), "repair-long-solved")
    exits = F.transform("solved.walks", lambda w: F.coalesce(w["state"], F.lit(-1)))
    chains = long.select("conv_id", "piece", exits.alias("exits")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("piece", "exits"))).alias("p"))
    states = F.pandas_udf(_entered, "array<int>")(F.transform("p", lambda x: x["exits"]))
    chains = chains.select("conv_id", F.explode(F.arrays_zip(F.transform("p", lambda x: x["piece"]).alias("piece"), states.alias("state"))).alias("z"))
    chains = chains.select(F.col("conv_id").alias("c"), F.col("z.piece").alias("k"), F.col("z.state").alias("state"))
    long = long.join(chains, mine & (F.col("piece") == F.col("k"))).drop("c", "k")
    both = whole.unionByName(long)
    return both.withColumns({"cost": F.col("solved.cost"), "audit": F.col("solved.walks")[F.col("state")]["audit"]}).drop("solved")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 per conversation of its pieces' lines, rows sorted by (number, piece)."""
    number, digest, skip = None, None, 1
    for batch in batches:
        for conv, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if conv != number:
                if digest is not None:
                    yield pa.RecordBatch.from_pydict({"number": [number], "digest": [digest.hexdigest()]})
                number, digest, skip = conv, hashlib.sha256(), 1
            if lines:
                digest.update(lines[skip:].encode())  # no line break before the first line
                skip = 0
    if digest is not None:
        yield pa.RecordBatch.from_pydict({"number": [number], "digest": [digest.hexdigest()]})


def _repaired(solved: DataFrame, rows: DataFrame) -> DataFrame:
    """conv_id and the sha256 of its repaired rows; conversations without any have no row."""
    outputs = F.pandas_udf(_outputs, "array<struct<row:int,role:string>>")("shape", "audit", "state")
    kept = solved.select("conv_id", "piece", "rows", F.posexplode(outputs).alias("line", "o")).select(
        "conv_id", "piece", "line", F.col("o.role").alias("new_role"),
        F.when(F.col("o.row") >= 0, F.get("rows", F.col("o.row"))).alias("row"))
    texts = rows.select(F.col("row"), F.col("role").alias("old_role"), F.col("text"))
    lines = kept.filter("row is not null").join(texts, "row").select(
        "conv_id", "piece", "line", F.concat(F.lit("\n"), F.coalesce("new_role", "old_role"), F.lit(":"), F.col("text")).alias("text"))
    lines = lines.unionByName(kept.filter("row is null").select(
        "conv_id", "piece", "line", F.concat(F.lit("\n"), F.col("new_role"), F.lit(":")).alias("text")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"]), "")
    blocks = stored(lines.groupBy("conv_id", "piece").agg(joined.alias("lines")), "repair-blocks")

    several = stored(blocks.groupBy("conv_id").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("c"), F.monotonically_increasing_id().alias("number")), "repair-several")
    mine = F.col("conv_id").eqNullSafe(F.col("c"))
    short = blocks.join(several, mine, "left_anti").select(
        "conv_id", F.sha2(F.substr("lines", F.lit(2)).cast("binary"), 256).alias("digest"))
    long = blocks.join(several, mine).select("number", "piece", "lines").repartition("number").sortWithinPartitions("number", "piece")
    long = long.select("number", "lines").mapInArrow(_digests, "number long, digest string")
    return short.unionByName(long.join(several, "number").select(F.col("c").alias("conv_id"), "digest"))


def _legal(pair: Column) -> Column:
    return pair.isin("su", "ua", "au")


def repair(conversations: DataFrame, rows: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """One row per conversation of ``conversations``: counts of its faults, the
    cost and audit of the cheapest edits, and the repaired text's sha256.
    ``rows`` are the rows to repair (conv_id, turn, role, text, copies), by
    default those of ``damaged``."""
    rows = damaged(conversations) if rows is None else rows
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "repair-texts")
    placed = _placed(rows, piece)
    sorted_rows = F.array_sort(F.collect_list(F.struct("at", "row", "code")))
    pieces = placed.groupBy("conv_id", "piece").agg(sorted_rows.alias("r")).select(
        "conv_id", "piece", F.transform("r", lambda x: x["row"]).alias("rows"),
        F.array_join(F.transform("r", lambda x: x["code"]), "").alias("shape"))
    solved = stored(_solve_pieces(stored(pieces, "repair-pieces")), "repair-solved")

    def letters(parity: int) -> Column:
        at = F.sequence(F.lit(1 + parity), F.length("shape"), F.lit(2))
        return F.transform(at, lambda i: F.substr("shape", i, F.lit(1)))

    def share(fault: str) -> Column:
        return F.size(F.filter(letters(1), lambda x: x == fault)).cast("long")

    initials = letters(0)
    inside = F.size(F.filter(F.transform(initials, lambda x, i: F.concat(x, F.get(initials, i + 1))),
                             lambda pair: pair.isNotNull() & ~_legal(pair))).cast("long")
    facts = solved.select("conv_id", "piece", "cost", "audit", share("b").alias("blank"), share("d").alias("duplicate"),
                          share("t").alias("truncated"), inside.alias("inside"),
                          F.element_at(initials, 1).alias("head"), F.element_at(initials, -1).alias("tail"))
    per = facts.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "inside")], F.max("cost").alias("cost"),
        F.array_sort(F.collect_list(F.struct("piece", "audit", "head", "tail"))).alias("p"))
    borders = F.size(F.filter(F.transform("p", lambda x, i: F.concat(x["tail"], F.get(F.col("p"), i + 1)["head"])),
                              lambda pair: pair.isNotNull() & ~_legal(pair)))
    per = per.select("conv_id", "blank", "duplicate", "truncated", (F.col("inside") + borders).alias("illegal"), "cost",
                     F.array_join(F.transform("p", lambda x: x["audit"]), "").alias("audit"))
    turns = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(
        (F.max("turn").cast("long") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))

    out = conversations.select("conv_id").distinct()
    for found in (turns, per, _repaired(solved, rows)):
        found = found.withColumnRenamed("conv_id", "c")
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    zero = [F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
