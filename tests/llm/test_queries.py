"""Registered queries against SQL, or against plain Python where SQL cannot express them; all on whole tables."""

import collections
import math
import re
import zlib

import pytest

import __spark_entry__ as entry
from tidemark.llm import mixing, queries, token_count
from tidemark.llm.common import staged

duckdb = pytest.importorskip("duckdb")
GAP = r"[\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(oracle):
    return dict(oracle.execute("SELECT doc_id, text FROM documents").fetchall())


def run(spark, sf_dir, name):
    return queries.QUERIES[name](spark, sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, sf_dir, oracle, name):
    df = run(spark, sf_dir, name)
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect())))
    result = oracle.execute(queries.ORACLES[name])
    at = [d[0] for d in result.description]
    assert sorted(at) == names
    want = sorted(map(repr, (tuple(r[at.index(c)] for c in names) for r in result.fetchall())))
    assert got and got == want


def test_all_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names


def test_token_counts_match_the_tokenizer(spark, sf_dir, texts):
    tokenizers = pytest.importorskip("tokenizers")
    pieces = token_count.vocabulary(f"{queries.TOKENIZERS}/piece_bpe_32k.model")
    lowest = min(s for _, s in pieces)
    model = tokenizers.Tokenizer(tokenizers.models.Unigram([("<unk>", lowest), *pieces], unk_id=0))
    for r in run(spark, sf_dir, "op1_token_counts").collect():
        text = texts[r["doc_id"]]
        tokens = model.encode("▁" + text.replace(" ", "▁"), add_special_tokens=False)
        known = [x for x in zip(tokens.ids, tokens.tokens) if x[0]]
        unknown = sum(len(t.encode()) for i, t in zip(tokens.ids, tokens.tokens) if not i)
        assert (r["n_tokens"], r["n_byte_tokens"]) == (len(known) + unknown, unknown), r["doc_id"]


def test_mixture_meets_its_budgets(spark, sf_dir, texts, oracle):
    rows = run(spark, sf_dir, "op4_mixture").collect()
    source = dict(oracle.execute("SELECT doc_id, source FROM documents").fetchall())
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", x or "")) for k, x in texts.items()}
    assert {r["doc_id"]: r["size"] for r in rows} == size and len(rows) == len(texts)
    whole = collections.Counter()
    for k, n in size.items():
        whole[source[k]] += n
    names = sorted(whole, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left, free = sum(whole.values()) - sum(3 * whole[s] for s in full), [s for s in names if s not in full]
        target = {s: 3 * whole[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in names}
        above = {s for s in free if target[s] > 3 * whole[s]}
        if not above:
            break
        full |= above
    taken = collections.Counter()
    for r in rows:
        s = source[r["doc_id"]]
        assert r["source_size"] == whole[s] and r["target"] == pytest.approx(target[s]) and 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 2 for s in names)
    again = {r["doc_id"]: r["taken"] for r in run(spark, sf_dir, "op4_mixture").collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_surrogates_leave_no_personal_data(spark, sf_dir, texts):
    rows = {r["doc_id"]: r for r in run(spark, sf_dir, "op6_surrogates").collect()}
    assert rows.keys() == texts.keys()
    planted = re.compile(r"[a-z.]+\d*@mail\d\.example\.com|AKIA[0-9A-Z]{16}|\b[0-9a-f]{40}\b|\+1 \(\d{3}\) 555-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.])|\b4\d{15}\b")
    changed = 0
    for k, text in texts.items():
        found = planted.findall(text)
        assert not [x for x in found if x in rows[k]["text"]]
        changed += bool(found)
        if not found and not rows[k]["n_mentions"]:
            assert rows[k]["text"] == text
    assert changed > 0


def test_model_scores(spark, sf_dir, texts):
    words = {k: (x or "").encode().lower().split() for k, x in texts.items()}
    crc = {k: zlib.crc32(str(k).encode()) % 7 for k in texts}
    count = collections.Counter(w for k, ws in words.items() if crc[k] != 2 for w in ws)
    end = sum(c != 2 for c in crc.values())
    n, v = sum(count.values()) + end, len(count) + 1
    held = [0.0, 0.0]
    for r in run(spark, sf_dir, "op7_model_scores").collect():
        own = words[r["doc_id"]]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own) + math.log10((end + 1) / (n + v + 1))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own) + 1, sum(count[w] > 0 for w in own) + 1, n)
        assert r["base_score"] == pytest.approx(base) and r["held_out"] == (crc[r["doc_id"]] == 2)
        assert r["score"] < 0
        if r["held_out"]:
            held[0] += r["base_score"]
            held[1] += r["score"]
    assert held[1] > held[0]


def test_toxicity_on_held_out_documents(spark, sf_dir, oracle):
    label = dict(oracle.execute("SELECT doc_id, toxic FROM labels").fetchall())
    rows = [r for r in run(spark, sf_dir, "op9_toxicity").collect()]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    area = sum((t > c) + 0.5 * (t == c) for t in toxic for c in clean) / (len(toxic) * len(clean))
    assert area > 0.75
    assert sum(c >= 0.3 for c in clean) <= 0.05 * len(clean)


@pytest.mark.parametrize("seed", range(12))
def test_fit_counts_is_exact_where_it_can_be(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(2, 60), 6, replace=False))
    counts = rng.integers(1, 4, 6)
    budget = int(rng.integers(1, (sizes * counts).sum() + 1))
    sums = {0}
    for s, c in zip(sizes.tolist(), counts.tolist()):
        sums = {x + s * k for x in sums for k in range(c + 1)}
    take = mixing.fit_counts(sizes, counts, budget, window=1 << 16)
    assert ((take >= 0) & (take <= counts)).all()
    assert int((take * sizes).sum()) == max(x for x in sums if x <= budget)


@pytest.mark.parametrize("sizes, counts, budget, best", [
    ((200_000, 300_000), (1, 1), 250_000, 200_000), ((150_000, 170_000, 190_000), (1, 1, 1), 340_000, 340_000),
    ((1000, 400_000), (5, 1), 402_000, 402_000), ((10**12,), (7,), 3 * 10**12 + 5, 3 * 10**12), ((3, 10**12), (2, 1), 10**11, 6),
    ((7, 9), (0, 0), 5, 0), ((), (), 5, 0), ((4, 6), (2, 2), 100, 20)])
def test_fit_counts_with_long_sizes(sizes, counts, budget, best):
    take = mixing.fit_counts(sizes, counts, budget, window=1 << 16)
    assert all(0 <= t <= c for t, c in zip(take, counts)) and sum(int(t) * s for t, s in zip(take, sizes)) == best


@pytest.mark.parametrize("seed", range(12))
def test_fit_counts_up_to_half_a_million(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    sizes = np.sort(np.concatenate([rng.integers(1000, 500_000, 5), rng.integers(1, 300, 2)]))
    counts = rng.integers(1, 4, 7)
    budget = int(rng.integers(1, (sizes * counts).sum() + 1))
    sums = {0}
    for s, c in zip(sizes.tolist(), counts.tolist()):
        sums = {x + s * k for x in sums for k in range(c + 1)}
    for window in (1 << 16, 100):
        take = mixing.fit_counts(sizes, counts, budget, window)
        assert ((take >= 0) & (take <= counts)).all()
        assert int((take * sizes).sum()) == max(x for x in sums if x <= budget)


def test_pipeline_keeps_what_each_stage_decides(spark, sf_dir, oracle):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixture", "shards"]
    docs = queries.table(spark, sf_dir, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        assert docs.columns[: len(columns)] == columns and (docs.columns == columns or name == "shards")
        seen.append(docs.toPandas())
    tox, near, clean, mixed, shards = seen
    toxic = {i for i, y in oracle.execute("SELECT doc_id, toxic FROM labels").fetchall() if y}
    assert len(toxic & set(tox.doc_id)) < 0.5 * len(toxic)
    con = duckdb.connect()
    con.execute("CREATE TABLE benchmark AS SELECT * FROM read_parquet('" + sf_dir + "/benchmark.parquet')")
    for frame, query, check in ((tox, "op2_near_duplicates", "kept"), (near, "op8_decontamination", "NOT contaminated")):
        con.execute("CREATE OR REPLACE TABLE documents AS SELECT * FROM frame")
        want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLES[query]}) WHERE {check}").fetchall()}
        assert set((near if query.startswith("op2") else clean).doc_id) == want
    assert set(mixed.doc_id) <= set(clean.doc_id) and mixed.doc_id.value_counts().max() <= 3
    con.execute("CREATE OR REPLACE TABLE documents AS SELECT DISTINCT * FROM mixed")
    want = dict(con.execute(f"SELECT doc_id, shard FROM ({queries.ORACLES['op5_shards']})").fetchall())
    assert len(shards) == len(mixed) and all(want[i] == s for i, s in zip(shards.doc_id, shards.shard))


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    lone = " ".join(f"u{i}" for i in range(60))
    rows = [(7, base, "a"), (7, base, "a"), (7, base, "b"), (7, base + " x", "a"), (None, base, "a"), (9, base + " y", "a")]  # repeated rows and ids
    rows += [(None, other + f" z{i % 3}", "a") for i in range(40)]  # a group without ids
    rows += [(7, lone, "a"), (8, "", "a"), (8, "", "a"), (None, None, "a"), (None, " \n", "a")]  # unlinked
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    words = [[r for r in kept if (r[1] or "").startswith(x)] for x in ("w", "v", "u")]
    assert [len(x) for x in words] == [1, 1, 1] and words[0][0][0] == 7 and words[1][0][0] is None
    assert sorted(map(repr, (r for r in kept if not (r[1] or "").strip()))) == sorted(map(repr, rows[-4:]))
    assert all(r in rows for r in kept)
