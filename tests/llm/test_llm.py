"""Each operator against plain code, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL
from parity import rows_of
from pyspark.sql import functions as F

from routeloom.llm import chat, decontaminate, line_dedup, ngram_join, packing, quality, sharding, token_counts, topk, toxicity
from routeloom.llm.components import components
from routeloom.llm.queries import ORACLES, QUERIES, tokenizer_path

CLASH = "doc_id long, text string, id string, h string, n string, row string, label string, component string"


def docs_of(spark, texts, ids=None):
    """Documents with further columns whose names the operators use themselves."""
    rows = [(i, t, "x", "x", "x", "x", "x", "x") for i, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, CLASH)


def words(rng, n, pool="the of red stone river walks under bright cold mountain seven temples near old bridge".split()):
    return " ".join(rng.choice(pool) + str(rng.randint(0, 40)) for _ in range(n))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), duck.sql(ORACLES[name]).df()
    assert rows_of(got) == rows_of(want)


@pytest.mark.parametrize("n", range(10))
def test_empty_tables(spark, n, tmp_path):
    name = sorted(QUERIES)[n]
    for t in ("documents", "labels", "benchmark", "embeddings", "conversations"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == (1 if "chat" in name else 0)


def test_token_counts(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = token_counts.load_tokenizer(path)
    rng = random.Random(1)
    texts = [None, "", "a  b\n\n\tc <|endoftext|> d", "x" * 900, words(rng, 400), " \n" * 300, "naïve 日本語 " * 60, words(rng, 50) + "y" * 700 + words(rng, 80), "a b"]
    texts.append(texts[4])
    got = sorted(tuple(r) for r in token_counts.count_tokens(docs_of(spark, texts), path, chunk_chars=256, overlap_chars=32, limit=100).collect())
    assert [r[:4] for r in got] == [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False)), n > 100) for i, t in enumerate(texts)]
    assert max(r[4] for r in got) > 3 and max(r[5] for r in got) > 0


def test_decontamination(spark):
    rng = random.Random(2)
    item = "Tom has 5 apples and gives 3 kg of flour to Anna before the school fair begins on Monday, as Tom said."
    twin = "jim has 12 apples and gives 7 lbs of flour to mary before the school fair begins on Friday, as"
    bench = spark.createDataFrame([(7, item), (8, item), (None, None), (9, "short item here"), (10, "")], "item_id long, text string")
    texts = [None, "", words(rng, 30) + " " + item, item.upper(), words(rng, 30), "It is short item here now", " ".join(item.split()[:6]), item.replace("Tom", "Jim").replace("5", "12").replace("3 kg", "7 lbs")]
    got = {r.doc_id: r for r in decontaminate.leaks(docs_of(spark, texts), bench).collect()}
    assert [list(got[i]["items"]) for i in range(8)] == [[], [], [7, 8], [7, 8], [], [9], [], [7, 8]]
    assert not got[4].contaminated and got[2].matched_words >= 13
    assert [r.doc_id for r in decontaminate.without_leaks(docs_of(spark, texts), bench).orderBy("doc_id").collect()] == [0, 1, 4, 6]
    # the same slot with two values is no copy under other parameters
    x = "Then Rome met 4 of them and then Rome lost 4 of them in the war that Rome won at last near 4 hills"
    broken = x.replace("met 4", "met 5").replace("lost 4", "lost 6")
    hits = decontaminate.leaks(docs_of(spark, [x.replace("4", "9"), broken]), spark.createDataFrame([(1, x)], "item_id long, text string")).orderBy("doc_id").collect()
    assert hits[0].contaminated and hits[0].matched_words > hits[1].matched_words and twin


def test_decontamination_of_a_long_passage_with_one_conflict(spark):
    rng = random.Random(12)
    letters = lambda n: ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]
    item = " ".join(letters(14) + ["5"] + letters(14) + ["5"] + letters(14))
    changed = item[::-1].replace("5", "6", 1)[::-1]  # the second of two equal numbers
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.leaks(docs_of(spark, [changed, item, " ".join(letters(44))]), bench).collect()}
    assert [got[i].contaminated for i in range(3)] == [True, True, False]
    assert got[0].matched_words >= 29 and got[1].matched_words == 44


def test_decontamination_of_verbatim_copies_full_of_numbers(spark):
    items = ["What is 12 times 7?", "Compute 12 + 7 - 5 * 3 / 2 + 9", "Rows: 4 8 15 16 23 42 km 7 9 11 13 17 19 21 years"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"Some words stand here. {x} And more of them behind." for x in items] + ["What is 13 times 8?", "Compute 1 + 2 - 3 * 4 / 5 + 6", "4 8 15 16 23 42"]
    got = {r.doc_id: list(r["items"]) for r in decontaminate.leaks(docs_of(spark, texts), bench).collect()}
    assert [got[i] for i in range(6)] == [[0], [1], [2], [], [], []]


def test_decontamination_in_passes(spark, monkeypatch):
    rng = random.Random(3)
    items = [(i, words(rng, 25)) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [words(rng, 20) + " " + items[i % 12][1] if i % 2 else words(rng, 40) for i in range(20)]
    want = rows_of(decontaminate.leaks(docs_of(spark, texts), bench).toPandas())
    monkeypatch.setattr(decontaminate, "GROUP_TOKENS", 100)
    assert rows_of(decontaminate.leaks(docs_of(spark, texts), bench).toPandas()) == want


def held_out(spark, got, column):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", F.col(column).alias("label"))
    rows = [r for r in got.join(labels, "doc_id").collect() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    order = np.argsort([r.score for r in rows])
    rank = np.empty(len(rows))
    rank[order] = np.arange(len(rows))
    y = np.array([r.label for r in rows])
    return (rank[y == 1].mean() - rank[y == 0].mean()) / len(rows) + 0.5


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op3_quality"](spark, sf)
    assert held_out(spark, got, "quality") > 0.95


def test_toxicity_held_out(spark):
    assert held_out(spark, QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1"), "toxic") > 0.95


@pytest.mark.parametrize("op", ["quality", "toxicity"])
def test_scores_mean_the_same_when_the_sample_is_capped(spark, op):
    rng = random.Random(13)
    rare = {i for i in range(900) if i % 9 == 0}  # of 900 rows, 100 of the rarer class
    texts = [words(rng, 12) + (" blargish" if rng.random() < (0.7 if i in rare else 0.1) else "") for i in range(900)]
    d = docs_of(spark, texts)
    fit, score, y = (quality.fit_quality, quality.score_quality, 0) if op == "quality" else (toxicity.fit_toxicity, toxicity.score_toxicity, 1)
    labels = spark.createDataFrame([(i, y if i in rare else 1 - y, y if i in rare else 1 - y) for i in range(900)], "doc_id long, quality int, toxic int")
    mean = {rows: np.mean([r.score for r in score(d, fit(d, labels, rows)).collect()]) for rows in (80, 10_000)}
    odds = {rows: np.log(m / (1 - m)) for rows, m in mean.items()}
    assert abs(odds[80] - odds[10_000]) < 0.7, mean


@pytest.mark.parametrize("op", ["quality", "toxicity"])
def test_scores_of_odd_texts(spark, op):
    texts = [None, "", " ", "a", "you idiot", "x" * 20000, "ok"]
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(7)] + [(None, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
    fit, score = (quality.fit_quality, quality.score_quality) if op == "quality" else (toxicity.fit_toxicity, toxicity.score_toxicity)
    d = docs_of(spark, texts, [0, 1, 2, 3, 4, None, 6])
    rows = score(d, fit(d, labels)).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0.5 for r in score(d, fit(d, labels.limit(0))).collect())
    if op == "quality":
        assert quality.keep_good(d, fit(d, labels.limit(0))).columns == d.columns


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(3000) < 0.3
    votes = np.zeros((3000, 5), np.int8)
    for k, right in enumerate((0.95, 0.9, 0.85, 0.8)):
        votes[:, k] = np.where((rng.random(3000) < right) == y, 1, -1)
    votes[:, 4] = votes[:, 3]  # a copy of a voter
    posterior, accuracy, strength = toxicity.label_model(votes, 0.5)
    assert ((posterior > 0.5) == y).mean() > 0.94 and accuracy[0] > accuracy[3] and strength[4] < 0.8 < strength[0]


def test_packing(spark):
    path = tokenizer_path("word_bpe_49k.json")
    tokenizer = token_counts.load_tokenizer(path)
    rng = random.Random(4)
    texts = [None, "", "<|endoftext|> Zoë's 日本 x² 12 don't"] + [words(rng, rng.randint(1, 90)) for _ in range(60)] + ["same"] * 5
    rows = packing.pack_documents(docs_of(spark, texts, [None, *range(1, 65), 3, 3, 3]), path, capacity=64).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    want = []
    for i, t in zip([None, *range(1, 65), 3, 3, 3], texts, strict=True):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, n, at, len(p := ids[at : at + 64]), zlib.crc32(np.array(p, "<u4").tobytes())) for n, at in enumerate(range(0, len(ids), 64))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    assert len(by_sequence) <= -(-sum(r.length for r in rows) // 64) * 1.1 + 1


def best_fit(lengths, capacity):
    """Sequences that plain best fit, longest first, opens."""
    gaps = []
    for x in sorted(lengths, reverse=True):
        holding = [k for k, g in enumerate(gaps) if g >= x]
        if holding:
            gaps[min(holding, key=lambda k: gaps[k])] -= x
        else:
            gaps.append(capacity - x)
    return len(gaps)


def test_sweep_is_as_tight_as_best_fit():
    rng = np.random.default_rng(3)
    for capacity, most in ((50, 50), (100, 30), (64, 5)):
        lengths, gaps = rng.integers(1, most + 1, 300), rng.integers(1, capacity, 12)
        sequence, offset, left = packing.sweep(lengths, gaps, capacity)
        for k in range(len(left)):
            at = capacity - gaps[k] if k < len(gaps) else 0
            for i in sorted(np.flatnonzero(sequence == k), key=lambda i: offset[i]):
                assert offset[i] == at
                at += lengths[i]
            assert at + left[k] == capacity and left[k] >= 0
        sequence, _, left = packing.sweep(lengths, gaps[:0], capacity)
        assert len(left) == best_fit(lengths, capacity)


def test_packing_in_many_stripes(spark, monkeypatch):
    monkeypatch.setattr(packing, "STRIPE_ROWS", 40)
    path = tokenizer_path("word_bpe_49k.json")
    rng = random.Random(14)
    texts = [words(rng, rng.randint(1, 30)) for _ in range(390)] + ["same words"] * 10
    rows = packing.pack_documents(docs_of(spark, texts), path, capacity=128).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        assert [o for o, _ in sorted(parts)] == [0, *itertools.accumulate(n for _, n in sorted(parts))][:-1] and sum(n for _, n in parts) <= 128
    assert len(rows) >= 400 and len(by_sequence) <= best_fit([r.length for r in rows], 128) + 10


def jaccard_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {" ".join(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[a] | sets[b]:
            p, q = root(a), root(b)
            top[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80), (2, 100)])
def test_ngram_join(spark, monkeypatch, width, percent):
    rng = random.Random(5)
    base = [words(rng, rng.randint(3, 60)).split() for _ in range(6)]
    rows = [(0, None), (1, ""), (2, "  \n"), (3, "one two"), (4, "ONE Two")]
    for i in range(5, 90):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w)))
    d = docs_of(spark, [t for _, t in rows])
    want = jaccard_components(rows, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(d, width, percent).collect()} == want
    # the same by many small sub-blocks; workers see the changed sizes through the plan alone
    monkeypatch.setattr(ngram_join, "PRODUCT_ROWS", 4)
    monkeypatch.setattr(ngram_join, "PRODUCT_ENTRIES", 100)
    monkeypatch.setattr(ngram_join, "HUBS", 1)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(d, width, percent).collect()} == want
    assert {r.doc_id for r in ngram_join.keep_one(d, width, percent).collect()} == {i for i, (_, c) in want.items() if i == c}


def test_ngram_join_repeated_and_null_ids(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    rows = ngram_join.ngram_components(docs_of(spark, [a, b, a, b, a], [5, 5, 3, 9, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in rows) == [(-1, None), (3, 3), (5, 3), (5, 3), (9, 3)]


def test_overlaps(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]
    assert ngram_join.overlaps(sets[:10], sets[10:]).astype(int).tolist() == want
    monkeypatch.setattr(ngram_join, "EXPANDED", 50)
    assert ngram_join.overlaps(sets[:10], sets[10:]).astype(int).tolist() == want


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rng, text, edits):
    text = list(text)
    for _ in range(edits):
        k = rng.randint(0, len(text))
        kind = rng.randint(0, 2)
        if kind == 0:
            text.insert(k, rng.choice("ab é"))
        elif k < len(text):
            text[k : k + 1] = [] if kind == 1 else [rng.choice("abcé ")]
    return "".join(text)


@pytest.mark.parametrize("k", [0, 1, 2, 4])
def test_within_edits(spark, k):
    rng = random.Random(6)
    pairs = []
    for _ in range(150):
        a = "".join(rng.choice("ab c") for _ in range(rng.randint(0, 16)))
        pairs.append((a, mutated(rng, a, rng.randint(0, 6))))
    d = spark.createDataFrame(pairs, "a string, b string")
    for r in d.select("a", "b", line_dedup.within_edits(F.col("a"), F.col("b"), k).alias("near")).collect():
        assert r.near == (edit_distance(r.a, r.b) <= k)


@pytest.mark.parametrize("k", [1, 2])
def test_line_dedup(spark, k):
    rng = random.Random(7)
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(5, 30))) for _ in range(12)]
    texts = [None, "", "short"] + ["\n".join(mutated(rng, rng.choice(base), rng.choice([0, 0, 1, 2])) for _ in range(rng.randint(1, 6))) for _ in range(30)]
    places = {(d, n): x for d, t in enumerate(texts) if t is not None for n, x in enumerate(t.split("\n")) if len(x) >= 8}
    distinct = sorted(set(places.values()))
    top = {x: x for x in distinct}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(distinct, 2):
        if abs(len(a) - len(b)) <= k and edit_distance(a, b) <= k:
            top[root(b)] = root(a)
    first, want = {}, {}
    for p in sorted(places):
        f = first.setdefault(root(places[p]), p)
        if f != p:
            want.setdefault(p[0], []).append(f"{p[1]}={f[0]}:{f[1]}")
    got = {r.doc_id: r for r in line_dedup.line_report(docs_of(spark, texts), k, 8, short_copies=False).collect()}
    assert {i: got[i].removed for i in got} == {i: ",".join(want.get(i, [])) for i in range(len(texts))}
    assert got[0].n_lines == 0 and got[1].n_lines == 1
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs_of(spark, texts), k, 8, short_copies=False).collect()}
    for i, t in enumerate(texts):
        gone = {int(x.split("=")[0]) for x in want.get(i, [])}
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone)
        assert kept.get(i, "gone") == (left if not gone or left.strip() else "gone")


def test_line_dedup_of_long_lines_at_more_edits(spark):
    rng = random.Random(17)
    base = ["".join(rng.choice("abcd é") for _ in range(n)) for n in (10, 17, 18, 19, 20, 21, 22, 28, 29, 30, 31, 32, 40)]
    lines = sorted({mutated(rng, x, rng.choice([0, 1, 1, 2, 2, 3])) for x in base for _ in range(14)})
    longer = ((20, 2), (30, 3))
    allowed = lambda n: 3 if n >= 30 else 2 if n >= 20 else 1
    top = {x: x for x in lines}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in itertools.combinations(lines, 2):
        least = min(len(a), len(b))
        if least >= 8 and edit_distance(a, b) <= allowed(least):
            top[root(b)] = root(a)
    first, want = {}, {}
    for i, x in enumerate(lines):
        f = first.setdefault(root(x), i)
        want[i] = "" if f == i else f"0={f}:0"
    got = line_dedup.line_report(docs_of(spark, lines), 1, 8, longer=longer).collect()
    assert {r.doc_id: r.removed for r in got} == want and len(set(first)) < len(lines)
    with pytest.raises(ValueError, match="longer lines"):
        line_dedup.line_report(docs_of(spark, lines), 2, longer=((30, 1),))


def test_pipeline_removes_repeats_of_short_lines(spark):
    from corpus_pipeline import line_dedup as stage

    texts = ["Les.\na long line that comes twice\n\nLes.", "Les.\na long line that comes twice\n\nLes.", "Let.\n \nLes.", "\n"]
    got = {r.doc_id: r.text for r in stage(spark, docs_of(spark, texts), "").collect()}
    assert got == {0: "Les.\na long line that comes twice\n", 2: "Let.\n ", 3: "\n"}


def test_line_dedup_is_native(spark):
    plan = line_dedup.line_report(docs_of(spark, ["a line that comes twice"] * 3))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_topk(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 6)], "x") for i in range(400)]
    rows += [(400 + i, [0.25] * 6, "x") for i in range(60)] + [(900, None, "x"), (920, [], "x"), (940, [1.0, None], "x"), (960, [float("nan")] * 6, "x"), (None, [1.0] * 6, "x"), (40, rows[40][1], "x")]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>, ids string")
    got = {}
    for r in topk.search(d, k=7).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    use = [(i, np.floor(np.array(v, np.float32).astype(float) * 64).astype(int)) for i, v, _ in rows[:460]]
    use.append(use[40])
    want = {}
    for i, q in use[:460]:
        if i % 20 == 0:
            best = sorted((-int(q @ v), j) for j, v in use if j != i)[:7]
            want[i] = [(n, j, -s) for n, (s, j) in enumerate(best, 1)]
    assert {i: sorted(v) for i, v in got.items()} == want


def test_topk_fewer_candidates(spark):
    d = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (20, [-1.0])], "vec_id long, embedding array<double>")
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(d).collect()) == [(0, 1, 1, 2048), (0, 2, 20, -4096), (20, 1, 1, -2048), (20, 2, 0, -4096)]


def test_cover_tree_invariants_and_pruning():
    rng = np.random.default_rng(4)
    spread = rng.normal(0, 40, (12, 1, 5)) * 50 + rng.normal(0, 30, (12, 60, 5))
    v = np.unique(np.floor(spread.reshape(-1, 5)), axis=0)
    levels, todo = 0, [(topk.cover_tree(v), None)]
    while todo:
        node, parent = todo.pop()
        levels += 1
        assert parent is None or parent in node.centres.tolist()  # nesting
        held = [kid.points.tolist() if kid is not None else [c] for kid, c in zip(node.kids, node.centres.tolist(), strict=True)]
        assert sorted(itertools.chain(*held)) == sorted(node.points.tolist())
        for kid, c, radius, points in zip(node.kids, node.centres.tolist(), node.radii, held, strict=True):
            away = np.sqrt(((v[points] - v[c]) ** 2).sum(axis=1))
            assert away.max() <= radius + 1e-9  # covering
            if len(node.centres) > 1:
                others = np.sqrt(((v[node.centres] - v[c]) ** 2).sum(axis=1))
                assert np.sort(others)[1] >= radius - 1e-9  # separation
            if kid is not None:
                todo.append((kid, c))
    assert levels > 20
    queries, k = v[::7], 3
    search = topk.Search(np.arange(len(queries)) * 7, queries, k)
    search.over(topk.cover_tree(v), v, [[i] for i in range(len(v))])
    for n, q in enumerate(queries):
        want = sorted(((int(q @ x), -i) for i, x in enumerate(v) if i != n * 7), reverse=True)[:k]
        assert sorted(search.best[n], reverse=True) == want


def test_topk_of_large_components(spark):
    d = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1e9, 2.0]), (2, [1e9, 3.0]), (20, [1e300, 0.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.search(d, k=2).collect()}
    assert got[0, 1] == (1, 2**63 - 1) and got[0, 2] == (2, 2**63 - 1) and got[20, 1] == (0, 2**63 - 1)
    small = spark.createDataFrame([(0, [2e7, 1.0]), (1, [2e7, 2.0]), (2, [2e7, 3.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in topk.search(small).orderBy("rank").collect()] == [(2, 1280000000**2 + 64 * 192), (1, 1280000000**2 + 64 * 128)]


def test_sharding(spark):
    texts = [None, "", "é"] + ["t"] * 300
    d = docs_of(spark, texts, [None, 1, 1, *range(2, 302)])
    rows = sharding.shard_documents(d, [1.0, 1.0, 2.0]).collect()
    assert sorted((r.size, r.text_crc32) for r in rows)[:2] == [(1, 0), (1, 0)] and (3, zlib.crc32("é".encode())) in {(r.size, r.text_crc32) for r in rows}
    for k in range(3):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    assert 100 < sum(r.shard == 2 for r in rows) < 200
    with pytest.raises(ValueError, match="weights"):
        sharding.rendezvous(F.lit("x"), [0.0])


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>", "a\\<|b", "<<|", "\\", "\\|", "<|im_end|>\n<|im_start|>user\n", "é日 ", "", None]
    turns = [(c, t, "assistant" if t % 2 else "us\ner", nasty[(c * 5 + t) % len(nasty)]) for c in range(6) for t in range(5)] + [(2, 3, "assistant", "again"), (None, 0, None, None)]
    events = spark.createDataFrame([(c, t, str(t), "message", r, x) for c, t, r, x in turns], "conv_id long, seq long, message_id string, kind string, role string, text string")
    for size in (1_000_000, 30):
        got = {r.conv_id: r for r in chat.read_back(chat.format_chat(events, size)).collect()}
        for c in {t[0] for t in turns}:
            own = sorted((t, r or "", x or "") for k, t, r, x in turns if k == c)
            said = "".join(x for _, r, x in own if r == "assistant")
            assert got[c].n_turns == len(own) and got[c].loss_chars == len(said)
            assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
            assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert all(chat.unescape(chat.escape(x)) == x and "<|" not in chat.escape(x) for x in nasty if x is not None)


def test_chat_folds_events(spark):
    log = [(1, 1, "m1", "message", "user", "hi"), (1, 2, "m2", "message", "assistant", ""), (1, 3, "m2", "delta", None, "wro"), (1, 4, "m2", "regenerate", None, None), (1, 5, "m2", "delta", None, "ri"), (1, 6, "m2", "delta", None, "ght"), (1, 7, "m1", "edit", None, "hello"), (1, 8, "m9", "delta", None, "lost")]
    events = spark.createDataFrame(log, "conv_id long, seq long, message_id string, kind string, role string, text string")
    got = [(r.role, r.text) for r in chat.fold_events(events).orderBy("seq").collect()]
    assert got == [("user", "hello"), ("assistant", "right"), ("assistant", "lost")]


def test_chat_unknown_kinds_and_clashing_columns(spark):
    log = [(1, 1, "m1", "message", "user", "hello"), (1, 2, "m1", "liked", None, "x"), (1, 3, "m1", None, None, "y"), (1, 4, "m2", "seen", "user", "z"), (None, 1, "m1", "message", "user", None), (1, 5, "m1", "message", "user", "again"), (1, 6, "m1", "delta", None, "!")]
    events = spark.createDataFrame([(*e, "t", "o", 9) for e in log], "conv_id long, seq long, message_id string, kind string, role string, text string, turn string, o string, life int")
    got = [(r.conv_id, r.seq, r.text) for r in chat.fold_events(events).orderBy("conv_id", "seq").collect()]
    assert got == [(None, 1, ""), (1, 1, "hello"), (1, 5, "again!")]


def test_chat_log_ends_in_its_turns(spark):
    from routeloom.llm.queries import as_log

    turns = [(1, 0, "user", "hi there"), (1, 1, "assistant", "a long answer"), (1, 1, "assistant", "a long answer"), (1, 2, "user", None), (1, 3, "assistant", ""), (2, 0, "system", "é日")]
    d = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    assert as_log(d).count() == 2 * 4 + 4 * 5
    got = sorted((r.conv_id, r.seq // 8, r.role, r.text) for r in chat.fold_events(as_log(d)).collect())
    assert got == sorted((c, t, r, x or "") for c, t, r, x in turns)


def test_training_rows_of_repeated_ids(spark):
    from routeloom.llm.labelled import training_rows

    d = docs_of(spark, [f"text {k}" for k in range(40)], [k % 4 + 1 for k in range(40)])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (4, 0), (4, 0), (None, 1)], "doc_id long, quality int")
    rows = training_rows(d, labels, "quality", 2).collect()
    assert len(rows) == len({r.doc_id for r in rows}) <= 4


def test_components(spark):
    rng = random.Random(9)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1080)] + [(5000, 5000 + k) for k in range(1, 60)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    top = {}

    def root(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            p, q = root(a), root(b)
            top[max(p, q)] = min(p, q)
    assert got == {x: root(x) for x in list(top)}


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, names = docs, docs.columns
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SMALL).cache()
        assert kept.columns == names
        sizes.append(kept.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[-1] > sizes[0] // 2
    left = kept.select("doc_id", "text").collect()
    want = jaccard_components([(r.doc_id, r.text) for r in left], 5, 80)
    assert all(i == c for i, (_, c) in want.items())
    packed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in left}


def test_word_ids_are_the_library_s_when_words_are_forgotten(monkeypatch):
    """Random texts with apostrophes, digits, white space and code points of either path."""
    monkeypatch.setattr(packing, "REMEMBERED", 200)
    ids_of = packing.WordIds(tokenizer_path("word_bpe_49k.json"))
    draw = random.Random(5)
    signs = ["abs'relvtmdT S.1\n", "abcEt'  \n\t.,!-éÉßĲž0129<|>«»'’ı中\x1c"]
    texts = ["".join(draw.choices(signs[k % 2], k=draw.randint(0, 70))) for k in range(3000)] + ["", "<|endoftext|> a"]
    for at in range(0, len(texts), 40):
        for text, raw in zip(texts[at : at + 40], ids_of.many(texts[at : at + 40]), strict=False):
            assert np.frombuffer(raw, "<u4").tolist() == ids_of.tokenizer.encode(text, add_special_tokens=False).ids
