import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from gotera.llm import components, decontaminate, jaccard, neighbours


def test_probing_order_is_by_score():
    rng = np.random.default_rng(0)
    place = rng.uniform(size=4)
    got = neighbours.probing_order(place, 40)
    score = lambda moved: sum(place[h] ** 2 if s < 0 else (1 - place[h]) ** 2 for h, s in moved)
    every = sorted(score([(h, s) for h, s in enumerate(c) if s]) for c in itertools.product((0, -1, 1), repeat=4))
    assert got[0] == () and len(set(map(frozenset, got))) == 40
    assert np.allclose([score(m) for m in got], every[:40])


def truth(rows, k, every):
    usable = [(i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in usable:
        if i % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in usable if j != i and len(w) == len(v))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def test_small_tables_are_searched_whole(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-3, 4)) for _ in range(6)]) for i in range(150)]
    rows += [(1_000 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 3.0]) for i in range(60)]
    rows += [(2_000, None), (2_001, [0.0] * 6), (2_002, [float("nan")] + [1.0] * 5), (2_003, [None] + [1.0] * 5),
             (2_004, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (2_005, []), (2_020, [1.0, 2.0]), (2_021, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = {}
    for r in neighbours.nearest(df, lambda v: v % 20 == 0, k=5, width=50.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == truth(rows, 5, 20)
    assert neighbours.nearest(df.limit(0), lambda v: v % 20 == 0).count() == 0


def test_double_vectors_keep_their_values(spark):
    """Components that floats cannot tell apart, or cannot hold."""
    rng = random.Random(8)
    rows = [(i, [1.0 + rng.randrange(9) * 1e-10, rng.choice([1e39, -1e39, 1.0]), rng.uniform(-1, 1)]) for i in range(80)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, lambda v: v % 20 == 0, k=5, width=50.0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == truth(rows, 5, 20)


def test_recall_and_large_cells(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(neighbours, "INDEX_PER_CELL", 40)
    monkeypatch.setattr(neighbours, "QUERIES_PER_CELL", 3)
    df = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/embeddings.parquet")
    rows = [(r["vec_id"], np.array(r["embedding"], dtype=np.float64)) for r in df.collect()]
    ids, data = np.array([r[0] for r in rows]), np.stack([r[1] for r in rows])
    found = {}
    for r in neighbours.nearest(df, lambda v: v % 20 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = data @ data[i]
        score[i] = -9
        recall.append(len(found[ids[i]] & set(ids[np.argsort(-score)[:20]])) / 20)
    assert np.mean(recall) >= 0.9


def test_one_long_vector_costs_no_recall(spark):
    """Scaled by one norm for all, single queries of this table found none of their neighbours."""
    data = np.random.default_rng(5).normal(size=(2_000, 64))
    data /= np.linalg.norm(data, axis=1)[:, None]
    data[7] *= 4
    data = data.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.nearest(df, lambda v: v % 20 == 0).collect():
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for i in range(0, 2_000, 20):
        score = data @ data[i]
        score[i] = -9
        recall.append(len(found[i] & set(np.argsort(-score)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.95 and min(recall) >= 0.6


def test_divide_skip_is_the_t_occurrence_count(monkeypatch):
    rng = random.Random(1)
    for _ in range(300):
        lists = [sorted(rng.sample(range(60), rng.choice([1, 2, 5, 30, 50]))) for _ in range(rng.randrange(1, 12))]
        need = rng.randrange(1, len(lists) + 2)
        counts = {m: sum(m in l for l in lists) for m in range(60)}
        expected = {m: c for m, c in counts.items() if c >= need}
        assert dict(zip(*jaccard.merge_skip(lists, need))) == expected
        ends = np.cumsum([len(l) for l in lists])
        keys = np.concatenate([np.array(l) + 60 * i for i, l in enumerate(lists)])
        for mu, probed in itertools.product((1e-6, 0.01, 1.0, 100.0), (1, 1 << 20)):
            monkeypatch.setattr(jaccard, "DIVIDE_MU", mu)
            monkeypatch.setattr(jaccard, "PROBED", probed)
            assert dict(zip(*map(np.ndarray.tolist, jaccard.divide_skip(keys, 60, np.r_[0, ends[:-1]], ends, need)))) == expected


def test_heap_and_probes_carry_the_searches_of_a_real_table(spark, sf_dir, monkeypatch):
    """All documents of a table in one cell: every search merges short lists by heap and probes the long ones."""
    texts = [r["text"] for r in spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet").select("text").collect()]
    words = jaccard.WordHashes()
    sets = [s for s in (jaccard.shingles(t, words) for t in texts) if len(s)]
    merged, probed, rule, merge = [], [], jaccard.set_aside, jaccard.merge_skip
    monkeypatch.setattr(jaccard, "set_aside", lambda longest, need: probed.append(rule(longest, need)) or probed[-1])
    monkeypatch.setattr(jaccard, "merge_skip", lambda lists, need: merged.append(len(lists)) or merge(lists, need))
    index = jaccard.CellIndex([(i, i, s) for i, s in enumerate(sets)], 80)
    got = [set(index.similar(s).tolist()) for s in sets]
    assert len(merged) == len(probed) == len(sets)
    assert sum(n > 0 for n in merged) > 0.9 * len(sets) and sum(n > 0 for n in probed) > 0.9 * len(sets)
    assert sum(merged) > 0.1 * sum(map(len, sets)) and sum(probed) > 0.5 * sum(map(len, sets))
    plain = [frozenset(s.tolist()) for s in sets]
    holders = {}
    for i, s in enumerate(plain):
        for token in s:
            holders.setdefault(token, []).append(i)
    for i, s in enumerate(plain):
        near = {j for token in s for j in holders[token]}
        assert got[i] == {j for j in near if 100 * len(s & plain[j]) >= 80 * len(s | plain[j])}
    assert sum(len(g) > 1 for g in got) > 50


def similar_texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [None, "", " \n", "one two", "One\ttwo", "one two three", "É x", "é x"]
    common = " ".join(word() for _ in range(25))
    for size in (6, 12, 40, 150, 400):
        for _ in range(6):
            base = [word() for _ in range(size)]
            texts.append(" ".join(base))
            for share in (0.02, 0.03, 0.05, 0.2):
                copy = list(base)
                for _ in range(max(1, int(size * share))):
                    copy[rng.randrange(size)] = word()
                texts.append(" ".join(copy))
            texts.append(" ".join(base[:int(size * 0.85)]))
            texts.append(" ".join(base).upper())
            texts.append(common + " " + " ".join(base[: size // 3]))
    # a chain in which each text is similar to the next only
    chain = [word() for _ in range(100)]
    for i in range(12):
        texts.append(" ".join(chain))
        chain = chain[8:] + [word() for _ in range(8)]
    hot = [word() for _ in range(60)]
    for i in range(80):
        copy = list(hot)
        copy[i % 60] = word()
        texts.append(" ".join(copy))
    texts += ["a b c d e f"] * 30
    return texts


def shingles_of(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def components_of(texts):
    sets = [shingles_of(t) for t in texts]
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j]:
            met = len(sets[i] & sets[j])
            if 100 * met >= 80 * (len(sets[i]) + len(sets[j]) - met):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_join_matches_brute_force(spark, monkeypatch):
    texts = similar_texts()
    expected = components_of(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("token", F.lit(1))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df).collect()}
    assert got == dict(enumerate(expected))
    kept = {r["doc_id"] for r in jaccard.one_of_each(df.withColumn("mark", F.lit(2))).collect()}
    assert kept == {i for i, (_, c) in enumerate(expected) if i == c}


def test_cells_alone_find_every_link(spark, monkeypatch):
    """Without the first links everything is left to the T-occurrence search, in cells of a few documents."""
    monkeypatch.setattr(jaccard, "CELL_DOCS", 7)
    calls = []
    monkeypatch.setattr(jaccard, "led", lambda star, sets_of, percent: calls.append(star.count()) or spark.createDataFrame(
        [], "a long, b long"))
    texts = similar_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df).collect()}
    assert got == dict(enumerate(components_of(texts))) and len(calls) == 1 and calls[0] > 0


def test_parts_without_documents_are_passed_over(spark, monkeypatch):
    """Four documents, each longer than a part, are dealt into more parts than there are documents."""
    monkeypatch.setattr(jaccard, "CELL_SHINGLES", 25)
    monkeypatch.setattr(jaccard, "led", lambda star, sets_of, percent: spark.createDataFrame([], "a long, b long"))
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:60 - i]) for i in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df).collect()}
    assert got == dict(enumerate(components_of(texts)))


def test_small_parts_and_often_held_tokens(spark, monkeypatch):
    """Leads that ask in many parts, and tokens that are dealt to many tasks, leave the result as it is."""
    monkeypatch.setattr(jaccard, "CELL_DOCS", 5)
    monkeypatch.setattr(jaccard, "OWN_DOCS", 2)
    monkeypatch.setattr(jaccard, "OFTEN", 3)
    monkeypatch.setattr(jaccard, "PACKED", 2_000)
    texts = similar_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df).collect()}
    assert got == dict(enumerate(components_of(texts)))


def test_join_of_null_keys_and_repeats(spark):
    rows = [(None, "a b c d e f g"), (5, "a b c d e f g"), (4, "A b c d e f g"), (4, "A b c d e f g"), (4, None), (None, None), (9, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(repr, ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df).collect())))
    assert got == sorted(map(repr, [(None, 3, 4), (5, 3, 4), (4, 3, 4), (4, 3, 4), (4, 0, 4), (None, 0, None), (9, 1, 9)]))
    kept = sorted(map(repr, ((r["doc_id"], r["text"]) for r in jaccard.one_of_each(df).collect())))
    assert kept == sorted(map(repr, [(4, "A b c d e f g"), (4, None), (None, None), (9, "z")]))
    assert jaccard.join_components(df.limit(0)).count() == 0 and jaccard.one_of_each(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(500, 500)]
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    label = {}

    def find(i):
        while label.setdefault(i, i) != i:
            i = label[i]
        return i

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            label[b] = a
    got = {r["node"]: r["comp"] for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in label}


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 12, 40, 70])))) for i in range(40)] + [(40, None), (41, ""), (1, "x y")]
    docs = [(i, " ".join(word() for _ in range(60))) for i in range(30)]
    for i, (_, text) in enumerate(items[:40]):
        said = text.split()
        for share in (0.03, 0.1, 0.3):
            part = list(said)
            for _ in range(int(len(part) * share)):
                part[rng.randrange(len(part))] = word()
            docs.append((1_000 + i * 10 + int(share * 20), " ".join([word() for _ in range(500)] + part + [word() for _ in range(300)]).upper()))
    docs += [(None, items[12][1]), (7, items[12][1]), (7, items[12][1]), (8, None), (9, "")]

    def cut(text):
        said = (text or "").lower().split()
        return {" ".join(said[i:i + 5]) for i in range(max(1, len(said) - 4))} if said else set()

    expected = []
    for d, text in docs:
        for i, item in items:
            a, b = cut(text), cut(item)
            if b and 100 * len(a & b) >= 80 * len(b):
                expected.append((d, i, len(b), len(a & b)))
    frames = (spark.createDataFrame(docs, "doc_id long, text string").withColumn("content", F.lit("c")),
              spark.createDataFrame(items, "item_id long, text string"))
    got = [(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in decontaminate.contamination(*frames).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected)) and len(expected) > 30
    clean = decontaminate.decontaminate(*frames).select("doc_id", "text", "content").collect()
    # by row, not by id: another row with the same id may be clean
    holds = lambda text: any(b and 100 * len(cut(text) & b) >= 80 * len(b) for b in (cut(item) for _, item in items))
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in clean))) == sorted(map(repr, ((d, t) for d, t in docs if not holds(t))))
    assert decontaminate.contamination(frames[0], frames[1].limit(0)).count() == 0
    assert decontaminate.decontaminate(frames[0].limit(0), frames[1]).count() == 0
