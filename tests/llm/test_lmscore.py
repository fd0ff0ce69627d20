"""The language model against plain Python: word counts, trie and context
counts read word by word, probabilities that sum to one."""
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from portalforge.llm import lmbits, lmscore


def _words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def _base(rows):
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows]
    counts = Counter(w for (_, t, *_), h in zip(rows, held) if not h for w in _words(t))
    n_docs = held.count(False)
    total, distinct = sum(counts.values()) + n_docs, len(counts) + (n_docs > 0)
    out = []
    for (i, t, *_), h in zip(rows, held):
        tokens = [counts[w] for w in _words(t)] + [n_docs]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in tokens)
        out.append((i, h, len(tokens), sum(c > 0 for c in tokens), total, round(base, 4)))
    return sorted(out, key=str)


def _facts(df):
    rows = df.collect()
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    return sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows], key=str)


def test_awkward_rows_and_clashing_columns(awkward, clashing, monkeypatch):
    rows = [tuple(r) for r in awkward.collect()]
    assert _facts(lmscore.scores(clashing(awkward).withColumn("row", F.lit(1)).withColumn("train", F.lit(1)))) == _base([(r[0], r[1]) for r in rows])
    monkeypatch.setattr(lmscore, "COMMON", 8)  # nearly every word is rare
    assert _facts(lmscore.scores(awkward)) == _base([(r[0], r[1]) for r in rows])


def test_no_training_rows_and_an_empty_table(documents):
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    assert _facts(lmscore.scores(documents([(only, "never learned from", "en", "s")])))[0][3:] == (0, 0, 0.0)
    assert lmscore.scores(documents([])).collect() == []


def _corpus(documents, n=300):
    rng = np.random.default_rng(4)
    stems = {"en": ["the", "and", "ing", "er"], "de": ["der", "und", "sch", "ung"]}
    rows = []
    for i in range(n):
        lang = ("en", "de")[i % 2]
        rows.append((i, " ".join("".join(rng.choice(stems[lang], rng.integers(1, 4))) for _ in range(rng.integers(1, 60))), lang, "s"))
    return documents(rows)


@pytest.mark.parametrize("common, block", [(1 << 20, 1 << 17), (64, 37)])
def test_the_layout_does_not_change_a_score(documents, monkeypatch, common, block):
    monkeypatch.setattr(lmscore, "COMMON", common)
    monkeypatch.setattr(lmscore, "BLOCK", block)
    docs = _corpus(documents)
    one, many = [{r.doc_id: (r.base_score, r.score) for r in lmscore.scores(docs.repartition(n)).collect()} for n in (1, 40)]
    assert one.keys() == many.keys()
    assert all(np.allclose(one[i], many[i], rtol=1e-9) for i in one)


def test_held_out_texts_are_likelier_than_under_word_counts(documents):
    rows = lmscore.scores(_corpus(documents, 600)).filter("held_out").collect()
    assert len(rows) > 30
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


WORDS = sorted({w.encode() for w in ("a an and ant anthem b bee been die der dies été ähre x" + " y" * 3 + " " + "long" * 12 + " " + "long" * 11 + "lost").split()})


def _block(words, counts, border=None):
    raw = np.frombuffer(b"".join(words), np.uint8)
    return lmbits.Block(raw, np.concatenate(([0], np.cumsum([len(w) for w in words]))), np.zeros(len(words), np.int64), np.array(counts), border)


def test_trie_counts_are_sums_over_words_with_the_prefix():
    counts = [3 * i % 7 for i in range(len(WORDS))]
    edges = _block(WORDS, counts).edges()
    assert len(edges.tail) == sum(max(len(w) - lmbits.DEPTH + 1, 0) for w in WORDS)

    def bits(word):
        return "".join(f"{b:08b}" for b in word + b"\0")

    for word, depth, symbol, path in zip(edges.word, edges.order, edges.symbol, edges.path):
        assert symbol == (WORDS[word] + b"\0")[depth]
        if depth < lmbits.DEPTH:
            for k in range(9):
                prefix = bits(WORDS[word])[:8 * depth + k]
                assert path[k] == sum(c for w, c in zip(WORDS, counts) if bits(w).startswith(prefix))


@pytest.mark.parametrize("cut", [[4], [1, 2, 9], list(range(1, len(WORDS)))])
def test_blocks_with_shared_prefixes_give_what_one_block_gives(cut):
    counts = [1 + 5 * i % 11 for i in range(len(WORDS))]
    weights, tables = lmbits.START, np.zeros(lmbits.ORDERS * lmbits.SLOTS * 2, np.float32)

    def totals(block):
        edges = block.edges()
        return block.word_sums(edges, lmbits.log_probabilities(edges, tables, weights))

    whole = totals(_block(WORDS, counts))
    parts = [(WORDS[a:b], counts[a:b]) for a, b in zip([0, *cut], [*cut, len(WORDS)])]
    border = {}
    for words, c in parts:
        for key, n in _block(words, c).borders().items():
            border[key] = border.get(key, 0) + n
    assert np.allclose(np.concatenate([totals(_block(w, c, border)) for w, c in parts]), whole)


def test_a_words_total_is_the_sum_of_its_own_bits():
    counts = [2] * len(WORDS)
    block = _block(WORDS, counts)
    edges = block.edges()
    tables = lmbits.counted(edges).astype(np.float32)
    values = lmbits.log_probabilities(edges, tables, lmbits.START)
    found = block.word_sums(edges, values)
    by_edge = {((WORDS[w] + b"\0")[:d + 1]): v for w, d, v in zip(edges.word, edges.order, values)}
    for word, total in zip(WORDS, found):
        assert math.isclose(total, sum(by_edge[(word + b"\0")[:d + 1]] for d in range(len(word) + 1)), rel_tol=1e-6)


def test_the_bytes_after_a_prefix_sum_to_one():
    words = sorted({bytes([97, b]) for b in range(1, 256) if b != 0x20})
    counts = [b % 5 for b in range(len(words))]
    block = _block([b"a", *words], [1, *counts])
    edges = block.edges()
    tables = lmbits.counted(edges).astype(np.float32)
    values = lmbits.log_probabilities(edges, tables, lmbits.START)
    second = [v for w, d, v in zip(edges.word, edges.order, values) if d == 1]
    assert len(second) == 255  # the end and 254 bytes; a blank is no word byte
    edges.symbol[:] = 0x20
    blank = edges.path[edges.order == 1][0]
    assert 0.99 < np.exp(second).sum() <= 1 + 1e-6 and blank[0] == sum(counts) + 1


def test_class_sequences_of_a_length_sum_to_one():
    share = np.full(lmbits.CLASSES, 0.02)
    share[lmbits.RARE] = 1 - share[:-1].sum()
    for length in (1, 2, 3):
        sequences = np.array(list(itertools.product(range(lmbits.CLASSES), repeat=length))).ravel()
        first = np.arange(0, len(sequences) + 1, length)
        assert math.isclose(np.exp(lmbits.class_log_probabilities(sequences, first, share)).sum(), 1, rel_tol=1e-6)


def test_a_texts_classes_do_not_depend_on_its_neighbours():
    share = np.full(lmbits.CLASSES, 1 / lmbits.CLASSES)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 3, n) * 8 for n in (0, 1, 5, 300, 0, 64, 65)]
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    together = lmbits.class_log_probabilities(np.concatenate(texts), first, share)
    alone = [lmbits.class_log_probabilities(t, np.array([0, len(t)]), share)[0] for t in texts]
    assert np.allclose(together, alone)


def _ordered(documents):
    """Texts in which a word says which four may follow, and held-out texts:
    new ones of the kind, each with a shuffled copy under the next free id."""
    rng = np.random.default_rng(8)
    names = [a + b + c for a in "bdfgkl" for b in "aeiou" for c in "mnrst"][:120]
    after = {w: rng.choice(names, 4) for w in names}

    def text():
        words = [str(rng.choice(names))]
        while len(words) < 60:
            words.append(str(rng.choice(after[words[-1]])))
        return words

    held = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0]
    learned = [i for i in range(700) if zlib.crc32(str(i).encode()) % 10 != 0]
    pairs, rows = [], [(i, " ".join(text()), "en", "s") for i in learned]
    for a, b in zip(held[:60:2], held[1:60:2]):
        words = text()
        pairs.append((a, b))
        rows += [(a, " ".join(words), "en", "s"), (b, " ".join(rng.permutation(words)), "en", "s")]
    return rows, pairs, names, held[60:]


def test_words_in_their_usual_order_are_likelier(documents):
    rows, pairs, _, _ = _ordered(documents)
    found = {r.doc_id: r for r in lmscore.scores(documents(rows)).collect()}
    assert all(found[a].score > found[b].score for a, b in pairs)
    assert all(math.isclose(found[a].base_score, found[b].base_score) for a, b in pairs)
    assert np.mean([found[a].score - found[b].score for a, b in pairs]) > 5  # 0.08 of a decimal digit a word


def test_the_texts_of_one_common_word_sum_to_one(documents):
    rows, _, names, free = _ordered(documents)
    ones = dict(zip(free, names))
    assert len(ones) == len(names)
    found = lmscore.scores(documents(rows + [(i, w, "de", "s") for i, w in ones.items()])).collect()
    tokens = found[0].train_tokens
    n_docs = sum(not r.held_out for r in found)
    hazard = (n_docs + 0.5) / (tokens + 1)
    rare = 1 / (tokens - n_docs + lmbits.CLASSES)  # no word is seen once; the classes without words have one token of the share each
    total = sum(10 ** r.score for r in found if r.doc_id in ones) / (hazard * (1 - hazard))
    assert math.isclose(total, 1 - rare * (lmbits.CLASSES - 1), rel_tol=1e-6)


def _tables(rng):
    mass = rng.random((lmbits.RARE, lmbits.CODES))
    cells = rng.integers(0, 40, lmbits.CONTEXTS * lmbits.PLACES * lmbits.CODES).astype(float)
    return lmbits.code_tables(mass, cells * (rng.random(len(cells)) < 0.3))


def test_code_sequences_of_a_length_sum_to_one():
    tables = _tables(np.random.default_rng(5))
    for classes in ([3], [3, 3], [3, lmbits.RARE, 7]):
        coded = [c != lmbits.RARE for c in classes]
        sequences = list(itertools.product(*[range(lmbits.CODES) if c else [5] for c in coded]))
        hashes = np.array(sequences, np.uint64).ravel() + np.uint64(64)
        first = np.arange(0, len(hashes) + 1, len(classes))
        found = lmbits.code_log_probabilities(hashes, first, np.tile(classes, len(sequences)), tables)
        assert math.isclose(np.exp(found).sum(), 1, rel_tol=1e-5)


def test_a_texts_codes_do_not_depend_on_its_neighbours():
    rng = np.random.default_rng(6)
    tables = _tables(rng)
    texts = [rng.integers(1, 1 << 60, n).astype(np.uint64) for n in (0, 1, 2, 300, 0, 16, 17)]
    kinds = [rng.choice([0, 4, lmbits.RARE], len(t)) for t in texts]
    first = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    together = lmbits.code_log_probabilities(np.concatenate(texts), first, np.concatenate(kinds), tables)
    alone = [lmbits.code_log_probabilities(t, np.array([0, len(t)]), k, tables)[0] for t, k in zip(texts, kinds)]
    assert np.allclose(together, alone)


def test_contexts_of_all_training_texts_are_counted(spark, documents):
    texts = ["b a b a b", None, "", "a", "a b zzz b  a", "c c c"] * 7
    words = [_words(t) for t in texts]
    vocabulary = sorted({w for t in words for w in t} - {"zzz"})
    raw = np.frombuffer("".join(vocabulary).encode(), np.uint8)
    hashes = lmscore.find_words(raw, np.arange(len(vocabulary) + 1)).hashes
    order = np.argsort(hashes)
    kind = {w: i % 2 for i, w in enumerate(vocabulary)}
    common = spark.sparkContext.broadcast((hashes[order], np.ones(len(order)), np.array([kind[vocabulary[i]] for i in order], np.int8), None))
    of = dict(zip(vocabulary, hashes))
    of["zzz"] = lmscore.find_words(np.frombuffer(b"zzz", np.uint8), np.array([0, 3])).hashes[0]
    seen = Counter()
    for text in words:
        for i, w in enumerate(text):
            if w in kind:
                past = np.array([*([0, 0] + [of[v] for v in text[:i]])[-2:], of[w]], np.uint64)
                # a text of three words in which the first two are the context
                at = lmbits.places(past, np.array([0, 3]), np.array([0, 0, kind[w]]), np.array([2]))
                seen.update((k, int(p[0]), int(of[w]) % lmbits.CODES) for k, p in enumerate(at))
    for n in (1, 5):
        cells = lmscore.code_contexts(documents([(i, t, "en", "s") for i, t in enumerate(texts)]).repartition(n), common)
        cells = cells.reshape(lmbits.CONTEXTS, lmbits.PLACES, lmbits.CODES)
        assert {tuple(map(int, at)): cells[tuple(at)] for at in np.argwhere(cells)} == dict(seen)


@pytest.mark.parametrize("held, size", [(1 << 20, 16 << 20), (3, 16 << 20), (1 << 20, 40)])
def test_a_task_sends_a_word_once_for_many_slices(monkeypatch, held, size):
    monkeypatch.setattr(lmscore, "HELD", held, raising=False)
    monkeypatch.setattr(lmscore, "HELD_BYTES", size, raising=False)
    texts = ["the cat " * 150_000, None, "a cat", "The dog\t" * 150_000, "", "été the " * 150_000]  # a slice has 1 MB
    train, kind = [True, True, True, False, True, True], [3, 3, 5, 3, 3, 3]
    columns = [pa.array(texts), pa.array(train), pa.array(kind, pa.int32())]
    batch = pa.RecordBatch.from_arrays(columns, ["text", "train", "kind"])
    sent = pa.Table.from_batches(lmscore._count_words(iter([batch.slice(0, 4), batch.slice(4)]))).to_pylist()
    n, n_all = Counter(), Counter()
    for row in sent:
        n[row["word"], row["kind"]] += row["n"]
        n_all[row["word"], row["kind"]] += row["n_all"]
    direct = Counter((w, k) for t, k in zip(texts, kind) for w in _words(t))
    assert n_all == direct
    assert +n == Counter((w, k) for t, k, learned in zip(texts, kind, train) if learned for w in _words(t))
    if held > 3 and size > 40:
        assert len(sent) == len(direct)  # before: a row of a word for each slice


def test_places_found_by_range_are_those_of_a_search():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 1000):
        for top in (5, 1 << 63):  # crowded into one range, and spread
            known = np.unique(rng.integers(0, top, n).astype(np.uint64) * np.uint64(2))
            asked = np.concatenate((known, known + np.uint64(1), rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2),
                                    np.array([0, (1 << 64) - 1], np.uint64)))
            common = (known, None, rng.integers(0, 16, len(known)).astype(np.int8), None)
            for a, b in zip(lmscore._classes(common, asked), lmscore._classes(common, asked, lmscore._ranges(known))):
                assert np.array_equal(a, b)


def test_rare_words_are_spelled_among_all_tokens_of_the_common_ones(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "COMMON", 8)
    tokens = {"walk": 900, "talk": 700, "walks": 3, "walking": 2, "talker": 1, "wombat": 5, "new": 0, "walkway" * 6: 4, "talkway" * 6: 0}
    n_all = 1700
    common = ["walk", "talk"]
    words = spark.createDataFrame([(w, n, max(n, 1), len(w) % 3) for w, n in tokens.items()], "word string, n long, n_all long, kind int")
    found = {r.word: r for r in lmscore.spelled(words, n_all).collect()}
    assert found.keys() == tokens.keys()
    assert {w for w, r in found.items() if r["class"] != lmbits.RARE} == set(common)

    rows = [(len(w) % 3, w) for w in common] + [(lmbits.RARE, w) for w in tokens]
    kind, listed = zip(*rows)
    block, table = lmscore._block(pa.table({"word": listed, "class": pa.array(kind, pa.int32()), "n": [tokens[w] for w in listed],
                                            "tokens": [tokens[w] for w in listed]}), None)
    edges = block.edges()
    tables = lmbits.counted(edges).astype(np.float32)
    ln_p = block.word_sums(edges, lmbits.log_probabilities(edges, tables, lmbits.train(edges, tables)[0]))
    at = {(k, w): p for k, w, p in zip(table.column("class").to_pylist(), table.column("word").to_pylist(), ln_p)}
    left = 1 - sum(math.exp(at[lmbits.RARE, w]) for w in common)
    assert 0 < left < 0.2
    for w, r in found.items():
        rare = w not in common
        assert math.isclose(r.ln_p, at[lmbits.RARE if rare else len(w) % 3, w] - (math.log(left) if rare else 0), rel_tol=1e-5)


def test_bytes_beyond_the_trie_are_learned_from_training_words_only():
    long = sorted([b"a" * 40, b"b" * 50 + b"c"])
    both, one = _block(long, [2, 0]), _block(long[:1], [2])
    assert np.array_equal(lmbits.counted(both.edges()), lmbits.counted(one.edges()))
    tables = lmbits.counted(one.edges()).astype(np.float32)
    weights, seen = lmbits.train(one.edges(), tables)
    assert seen.sum() == 2 * 8 * 41  # two tokens of forty bytes and an end
    assert np.array_equal(weights, lmbits.train(both.edges(), tables)[0]) and not np.array_equal(weights, lmbits.START)
