"""Repair against a plain Python reading of the rules: every edit sequence's
cost and audit by dynamic programming over (cost, audit) pairs."""
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from portalforge.llm import lattice, repair

SCHEMA = "conv_id long, turn int, role string, text string"


def _damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def _next(state):
    return "a" if state == "u" else "u"


def _best(rows, faults):
    """(cost, audit, lines) by state: e(mpty), s, u, a."""
    def closed(best):
        best = dict(best)
        for _ in range(3):
            for q, (cost, audit, lines) in list(best.items()):
                new, name = _next(q), "assistant:" if _next(q) == "a" else "user:"
                best[new] = min(best.get(new, (9e9,)), (cost + 3, audit + "I", lines + [name]))
        return best

    best = {"e": (0, "", [])}
    for (role, text), fault in zip(rows, faults):
        after = {}
        for q, (cost, audit, lines) in closed(best).items():
            options = [(q, 4, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                i = role[:1]
                if (i == "s" and q == "e") or (i == "u" and q != "u") or (i == "a" and q == "u"):
                    options.append((i, more, "K", [f"{role}:{text}"]))
                name = "assistant" if _next(q) == "a" else "user"
                options.append((_next(q), 3 + more, "R", [f"{name}:{text}"]))
            for to, more, op, line in options:
                after[to] = min(after.get(to, (9e9,)), (cost + more, audit + op, lines + line))
        best = after
    return min(v for q, v in closed(best).items() if q in "ea")


def brute(rows):
    out = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows}
    for conv in out:
        mine = sorted((r for r in _damage(rows) if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        if not mine:
            continue
        pairs, faults = [(r[2], r[3]) for r in mine], []
        for i, (role, text) in enumerate(pairs):
            body = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in pairs[:i]
                          else "truncated" if body[-1] not in ".!?" else "")
        turns = {r[1] for r in mine} - {None}
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(pairs, pairs[1:]))
        cost, audit, lines = _best(pairs, faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                     illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def _same(spark, rows, **how):
    got = repair.repair(spark.createDataFrame(rows, SCHEMA), **how).collect()
    found = {r[0]: tuple(r)[1:] for r in got}
    assert len(got) == len(found)
    assert found == brute(rows)
    return found


def _random_rows(seed, n_conv, n_turn):
    rng = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "sys", "ua"]
    texts = ["Fine.", "cut off", "", " \t\n", "Why?", "Fine. \n", None, "ends. ", "ünï!", "a.b"]
    rows = []
    for conv in range(n_conv):
        for turn in range(rng.randint(1, n_turn)):
            if rng.random() < 0.9:
                rows.append((conv, rng.choice([turn, turn, turn, turn // 2, None]), rng.choice(roles), rng.choice(texts) if rng.random() < .5 else f"t{turn}."))
    return rows


def test_random_conversations(spark):
    _same(spark, _random_rows(1, 120, 9))


@pytest.mark.parametrize("piece", [2, 7])
def test_long_conversations_are_solved_in_pieces(spark, piece):
    rows = _random_rows(2, 12, 60) + [(99, t, ["user", "assistant"][t % 2], f"line {t}" + "." * (t % 3)) for t in range(150)]
    _same(spark, rows, piece=piece)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, None), (None, 3, "user", "x."), (1, 1, "user", "b."), (1, 1, "user", "a."), (1, 1, "assistant", "z."),
            (2, None, "user", "n."), (2, None, "assistant", "m."), (3, 5, "user", "same.")] + [(4, 0, "user", "rep.")] * 30
    found = _same(spark, rows)
    assert found[4][2] >= 29


def test_a_hot_repeated_row_is_spread_over_pieces(spark):
    rows = [(1, 2, "user", "same."), (1, 3, "assistant", "ok.")]
    copies = spark.createDataFrame([(1, 2, "user", "same.", 500), (1, 3, "assistant", "ok.", 1)], SCHEMA + ", copies long")
    got = repair.repair(spark.createDataFrame(rows, SCHEMA), rows=copies, piece=16).collect()
    assert [(r.duplicate, r.cost, r.audit) for r in got] == [(499, 4 * 499, "K" + "D" * 499 + "K")]


def test_a_conversation_that_loses_every_row_and_an_empty_table(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert _same(spark, [(conv, 0, "user", "gone.")])[conv][5:7] == (0, "")
    assert repair.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_extra_columns_with_clashing_names(spark):
    rows = _random_rows(3, 10, 6)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "copies", "piece", "at", "c", "cost", "shape", "kind"):
        df = df.withColumn(name, F.lit("x"))
    assert {r[0]: tuple(r)[1:] for r in repair.repair(df).collect()} == brute(rows)


def test_very_long_texts(spark):
    rows = [(1, 0, "user", "word " * 100_000), (1, 1, "assistant", "ok."), (1, 2, "user", "word " * 100_000)]
    _same(spark, rows, piece=64)


def test_search_meets_in_the_middle_with_every_tie():
    rng = random.Random(5)
    for _ in range(3000):
        rows = [(rng.choice(["system", "user", "assistant", "x"]), "t", rng.choice(["blank", "duplicate", "truncated", "", ""]))
                for _ in range(rng.randint(0, 8))]
        shape = "".join((r[0] if r[0] in "sua" else "-") + (f[:1] or ".") for r, _, f in rows)
        cost, audit, _ = _best([(r, t) for r, t, _ in rows], [f for *_, f in rows])
        found, walks = lattice.cheapest(shape)
        assert (found, walks[lattice.NOTHING][1]) == (cost, audit)
