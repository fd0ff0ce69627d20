"""Budgets and prefixes against a plain recursive version."""
import hashlib
import random
import re
from fractions import Fraction

from portalforge.llm import mixing


def _fill(children, budget):
    """children: name -> (capacity, weight); floors of shares, full ones first."""
    out, left = {}, budget
    order = sorted((n for n, (c, w) in children.items() if c > 0), key=lambda n: (children[n][0] / children[n][1], n))
    weight = sum(children[n][1] for n in order)
    while order:
        c, w = children[order[0]]
        if Fraction(c) * weight > Fraction(w) * left:
            break
        out[order.pop(0)] = c
        left, weight = left - c, weight - w
    for n in order:
        out[n] = children[n][1] * left // weight
    return out


def brute(rows, weights, percent, epochs, seed):
    number = lambda s: int(m[0]) if (m := re.search(r"[0-9]+$", s or "")) else 0
    docs = [(i, (f"domain{number(s) % 3}", lang if lang is not None else "none", s if s is not None else "none"),
             len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, lang, s in rows]
    w = lambda level, name: max(weights.get(level, {}).get(name, 1), 0)
    tokens, usable = {}, {}
    for _, leaf, n in docs:
        tokens[leaf] = tokens.get(leaf, 0) + n
    for leaf in tokens:
        usable[leaf] = tokens[leaf] * epochs if all(w(k, v) for k, v in zip(mixing.LEVELS, leaf)) else 0
    budget = {(): min(sum(tokens.values()) * percent // 100, sum(usable.values()))}
    for depth, level in enumerate(mixing.LEVELS):
        for parent in [p for p in budget if len(p) == depth]:
            names = {leaf[depth] for leaf in tokens if leaf[:depth] == parent}
            kids = {n: (sum(c for leaf, c in usable.items() if leaf[:depth + 1] == (*parent, n)), w(level, n)) for n in names}
            for n, b in _fill(kids, budget[parent]).items():
                budget[(*parent, n)] = b
    out = []
    for leaf, total in tokens.items():
        b = budget.get(leaf, 0)
        if not total:
            continue
        whole, rest = divmod(b, total)
        own = [(i, n) for i, at, n in docs if at == leaf]
        for e in range(1, whole + 1):
            out += [(i, e) for i, _ in own]
        key = lambda x: (hashlib.md5(":".join([seed, str(whole + 1)] + ([] if x[0] is None else [str(x[0])])).encode()).hexdigest(), x[0], x[1])
        upto = 0
        for i, n in sorted(own, key=key) if rest else []:
            upto += n
            if upto > rest:
                break
            out.append((i, whole + 1))
    return sorted(out, key=str)


def _rows(n=600):
    draw = random.Random(9)
    rows = []
    for i in range(n):
        src = "src0" if draw.random() < .4 else f"src{draw.randrange(12)}"
        rows.append((i, " ".join(["w"] * draw.randrange(0, 80)), draw.choice(["en", "en", "de", "fr", "es", "it"]), src))
    return rows


def test_equals_recursive_version(documents):
    rows = _rows() + [(900, None, None, None), (901, "a b c", None, "odd"), (902, "", "en", None), (900, "x y", "en", "src3")]
    for weights, percent, epochs in ((mixing.WEIGHTS, 60, 2), (mixing.WEIGHTS, 170, 2), (mixing.WEIGHTS, 300, 3), ({}, 7, 1),
                                     ({"domain": {"domain1": 0}, "lang": {"en": 50, "de": 0}}, 90, 2)):
        got = mixing.mix(documents(rows), weights=weights, budget_percent=percent, max_epochs=epochs, seed="s")
        assert sorted(((r.doc_id, r.epoch) for r in got.collect()), key=str) == brute(rows, weights, percent, epochs, "s")


def test_shortage_goes_to_siblings_first():
    """A short source's share stays in its language, a full language's in its domain."""
    kids = _fill({"a": (10, 1), "b": (100, 1), "c": (100, 2)}, 130)
    assert kids == {"a": 10, "b": 40, "c": 80}


def test_defined_cases(awkward, clashing):
    got = mixing.mix(clashing(awkward), keep=("text", "n_chars", "epoch", "budget"))
    assert got.columns[:4] == ["text", "n_chars", "keep_epoch", "budget"]
    rows = awkward.select("doc_id", "text", "lang", "source").collect()
    want = brute([tuple(r) for r in rows], mixing.WEIGHTS, mixing.BUDGET_PERCENT, mixing.MAX_EPOCHS, mixing.SEED)
    assert sorted(((r.doc_id, r.epoch) for r in got.collect()), key=str) == want
    assert mixing.mix(awkward.limit(0)).count() == 0


def test_plan_has_no_python(documents):
    plan = mixing.mix(documents(_rows(50)))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
