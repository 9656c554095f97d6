"""Spelling variants, SimHash groups and the prefix trie against plain Python, with odd rows, ties and small cells."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie, queries, sim_dedup, spelling

SCHEMA = "doc_id long, text string, source string, word string, n long, fp long, cell long, path string"
LONG = "lorem ipsum dolor sit amet " * 20_000


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "s", "w", 1, 2, 3, "p") for i, t in pairs], SCHEMA)


# -- spelling ------------------------------------------------------------------------------------------------
def plain_variants(pairs, length=5, least=3, factor=2, damage=None):
    n = collections.Counter()
    for k, text in pairs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{k}:{w}".encode())
            if damage and k is not None and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: q for w, q in n.items() if len(w) >= length and q >= least}
    near, blank = collections.defaultdict(set), collections.defaultdict(list)
    for w in n:
        for i in range(len(w)):
            if (k := w[:i] + w[i + 1 :]) in n:
                near[w].add(k)
                near[k].add(w)
            blank[w[:i] + "*" + w[i + 1 :]].append(w)
    for same in blank.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= factor * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n)


def found_variants(df):
    return sorted(map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect()))


WIDE = "z" * 100
ODD = [
    (1, "Harbor harbor HARBOR harbor harbor harbor harbor harbor"), (2, "harbour harbour harbour harbours harbours harbours"), (3, None),
    (4, ""), (None, "garden garden garden gardem gardem gardem Ägarden Ägarden Ägarden"), (5, "abcde abcde abcde abcdef abcdef abcdef fbcde fbcde fbcde"),
    (5, "abcde abcde abcde"), (6, f"{WIDE} {WIDE} {WIDE} {WIDE}y {WIDE}y {WIDE}y y{WIDE} y{WIDE} y{WIDE} {WIDE[1:]}x {WIDE[1:]}x {WIDE[1:]}x"),
    (7, "×÷×÷× ×÷×÷× ×÷×÷× ×÷×÷ß ×÷×÷ß ×÷×÷ß"), (8, LONG), (9, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaaaaa aaaaaaa aaaaaaa" * 2)]


@pytest.mark.parametrize("cell, damage", [(50_000, None), (3, None), (3, 2)])
def test_variants_of_odd_rows(spark, cell, damage):
    got = found_variants(spelling.spelling_variants(docs_of(spark, ODD), cell=cell, damage=damage))
    assert got == plain_variants(ODD, damage=damage)
    assert ("harbours", 3, 1, None, None, "harbours") in got or damage


def test_variants_of_random_words(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdé"), rng.integers(5, 9))) for _ in range(700)]
    pairs = [(i, " ".join([w] * int(rng.integers(3, 60)))) for i, w in enumerate(words)]
    want = plain_variants(pairs)
    assert found_variants(spelling.spelling_variants(docs_of(spark, pairs), cell=40)) == want
    assert any(r[5] not in (r[0], r[3]) for r in want)  # chains of more than one step


def test_no_words(spark):
    assert spelling.spelling_variants(docs_of(spark, [])).collect() == []
    assert spelling.spelling_variants(docs_of(spark, [(1, None), (2, "a b c")])).collect() == []


def test_a_budget_reaches_every_edit():
    alike = {tuple(s) for s in spelling.steps(16)}
    rng = np.random.default_rng(4)
    for _ in range(300):
        w = bytes(rng.integers(97, 123, rng.integers(1, 12)).astype(np.uint8))
        i, c = int(rng.integers(0, len(w))), bytes([int(rng.integers(97, 123))])
        for other in (w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]):
            a, b = (np.bincount(np.frombuffer(x, np.uint8) % 16, minlength=16) for x in (w, other))
            assert tuple((b - a).tolist()) in alike


# -- SimHash -------------------------------------------------------------------------------------------------
def plain_print(text, width=4):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(pairs, distance=4):
    """(doc_id, fingerprint, component) by comparing all with all."""
    prints = [plain_print(t) for _, t in pairs]
    group = list(range(len(pairs)))
    for a in range(len(pairs)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, _) in zip(group, pairs):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return sorted(((i, f"{p:016x}", least.get(g)) for g, p, (i, _) in zip(group, prints, pairs)), key=repr)


def found_groups(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_groups_of_odd_rows(spark):
    pairs = [(1, "A b c d e"), (2, "a\tB  c d e"), (2, "a b c d e"), (3, None), (4, ""), (5, " \n "), (None, "lone words that nobody else has"),
             (None, None), (6, LONG), (7, LONG.upper()), (8, "x" * 300_000), (9, "two words"), (10, "TWO words"), (11, "ÀB c d e é 😀")]
    assert found_groups(sim_dedup.sim_duplicates(docs_of(spark, pairs))) == plain_groups(pairs)
    assert sim_dedup.sim_duplicates(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("cell", [5, 4096])
def test_groups_of_near_copies(spark, cell):
    rng = np.random.default_rng(8)
    pairs = []
    for _ in range(6):
        base = [f"w{x}" for x in rng.integers(0, 500, 150)]
        for _ in range(40):
            own = list(base)
            own[int(rng.integers(0, len(own)))] = f"e{rng.integers(0, 10**6)}"
            pairs.append((1000 - len(pairs), " ".join(own)))
    want = plain_groups(pairs)
    assert found_groups(sim_dedup.sim_duplicates(docs_of(spark, pairs), cell=cell)) == want
    assert 1 < len({r[2] for r in want}) < 200


@pytest.mark.parametrize("distance", [2, 3, 4, 5])
def test_every_near_pair_shares_a_key(spark, distance):
    rng = np.random.default_rng(distance)
    a = rng.integers(0, 1 << 63, 300)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(1, distance + 1), replace=False)) for _ in a]
    b = a ^ np.array(flips, np.uint64).view(np.int64)
    rows = [(int(x),) for x in np.concatenate([a, b])]
    links = sim_dedup.SimHash(docs_of(spark, []), distance=distance).links(spark.createDataFrame(rows, "fp long")).collect()
    assert {frozenset((r.a, r.b)) for r in links} == {frozenset((int(x), int(y))) for x, y in zip(a, b)}


def test_links_of_a_crowd_stay_few(spark):
    rng = np.random.default_rng(1)
    rows = sorted({int(sum(1 << int(b) for b in rng.choice(16, 2, replace=False))) for _ in range(2000)})
    links = sim_dedup.SimHash(docs_of(spark, []), cell=16).links(spark.createDataFrame([(x,) for x in rows], "fp long"))
    n = links.count()
    assert len(rows) - 1 <= n < len(rows) * (len(rows) - 1) / 2  # all pairs are near; a forest per cell comes out


# -- prefix trie ---------------------------------------------------------------------------------------------
COLUMNS = "conv_id long, turn long, role string, text string, depth long, x1 long, last string"


def plain_trie(rows, borrow=None):
    turns = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    built = dict(turns)
    if borrow:
        for c, v in turns.items():
            h = zlib.crc32(str(c).encode()) % 6
            built[c] = turns.get(c - int(math.fmod(c, borrow)), [])[:h] + v[h:]
    members = collections.defaultdict(list)
    for c, v in built.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    born = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += born[k] == 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), born[k], leaves[k], saved[k], hashlib.sha256(
        ",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest()) for k, m in members.items())


def found_trie(df):
    rows = df.select("conv_id", "depth", F.coalesce("parent_conv_id", F.lit(-1)), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, rows.collect()))


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], COLUMNS)


ODD_TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (3, 0, "user", "hi"), (3, None, "system", None),
    (4, None, None, None), (5, 0, "user", ""), (6, 0, "", "user"), (7, 0, "user", "hi"), (7, 1, "assistant", "hello"), (7, 2, "user", "é😀" * 3),
    (None, 0, "user", "hi"), (100, 5, "user", LONG), (101, 0, "user", "own"), (101, 9, "user", "own"), (300, 0, "user", "hi"), (8, 3, "a", "b"), (8, 3, "a", "b"),
    (250, 0, "user", "x"), (250, 1, "user", "y"), (250, 2, "user", "z"), (250, 3, "user", "z"), (250, 4, "user", "z"), (250, 5, "user", "last")]


@pytest.mark.parametrize("borrow", [None, 100])
def test_trie_of_odd_turns(spark, borrow):
    assert found_trie(prefix_trie.prefix_trie(turns_of(spark, ODD_TURNS), borrow=borrow)) == plain_trie(ODD_TURNS, borrow)


def test_trie_without_conversations(spark):
    assert prefix_trie.prefix_trie(turns_of(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(turns_of(spark, [(None, 1, "a", "b")]), borrow=100).collect() == []


@pytest.mark.parametrize("max_width", [1 << 10, 1 << 24])
def test_trie_does_not_depend_on_the_sketch(spark, max_width):
    rng = np.random.default_rng(6)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"t{rng.integers(0, 3)}") for c in range(60) for t in range(int(rng.integers(1, 5)))]
    rows += [(c, t, "user", f"chain {t}") for c in (900, 901) for t in range(60)]  # deep, shared by two
    rows += [(902, t, "user", f"own {t}") for t in range(200)]  # most rows in one conversation
    turns = turns_of(spark, rows)
    assert found_trie(prefix_trie.prefix_trie(turns, borrow=100, max_width=max_width)) == plain_trie(rows, 100)


def test_single_prefixes_are_not_shuffled(spark):
    rows = [(c, t, "user", f"{c} {t}" if t else "same start") for c in range(300) for t in range(6)]
    trie = prefix_trie.PrefixTrie(turns_of(spark, rows))
    screened = trie.screened(trie.prefixes()[0])
    exact = screened.where("shared OR after_shared").count()
    assert 600 <= exact < 700  # the shared start and what follows it, but for a few wrong estimates


def test_trie_query_matches_plain_python(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()
    assert found_trie(queries.op13_prefix_trie(spark, sf_dir)) == plain_trie(map(tuple, rows), 100)


def test_simhash_query_matches_plain_python(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    got = {r.doc_id: r for r in queries.op12_sim_duplicates(spark, sf_dir).collect()}
    assert {k: f"{p:016x}" for k, p in prints.items()} == {k: r.fingerprint for k, r in got.items()}
    ids = sorted(prints)
    least = {k: k for k in ids}
    values = np.array([prints[k] for k in ids], np.uint64)
    for i, k in enumerate(ids):  # ascending, so that names only fall
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4):
            a, b = least[k], least[ids[j]]
            if a != b:
                least = {x: min(a, b) if g in (a, b) else g for x, g in least.items()}
    assert {k: r.component_id for k, r in got.items()} == least
