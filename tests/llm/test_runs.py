import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gotera.llm import runs


def brute(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= max(q, least - q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def samples():
    rng = random.Random(4)
    word = lambda n: rng.choice("abcdefghijklmnopqrstuvwxyz"[:n])
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 100, ["a", "b"] * 6, ["a", "b"] * 6 + ["a"], ["a", "b", "c"] * 4]
    for size in (13, 40, 200):
        for letters in (1, 2, 3, 26):
            out.append([word(letters) for _ in range(size)])
    for period in (1, 2, 3, 5, 6, 7, 8, 9, 14, 15, 16, 31, 33, 64):
        loop = [word(26) for _ in range(period)]
        out.append([word(26) for _ in range(rng.randrange(9))] + loop * 2 + loop[:rng.randrange(period + 1)] + [word(26)] * 3 + loop * 3)
    strange = ["a", "b"]
    while len(strange) < 400:
        strange.append("b" if strange[len(strange) // 2] == "a" and len(strange) % 2 == 0 else "a" if len(strange) % 3 else "b")
    fibonacci = [["a"], ["a", "b"]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    morse = [bin(i).count("1") % 2 for i in range(512)]
    return out + [strange, fibonacci[-1], [str(m) for m in morse]]


@pytest.mark.parametrize("appended,merged", [(1 << 16, 1 << 20), (7, 3)])
def test_runs_match_brute_force(monkeypatch, appended, merged):
    monkeypatch.setattr(runs, "APPENDED", appended)
    monkeypatch.setattr(runs, "MERGED", merged)
    texts = [[w.encode() for w in t] for t in samples()]
    got = runs.find_runs(texts, runs.Numbers())
    assert [list(map(tuple, g.tolist())) for g in got] == [brute(t) for t in texts]
    assert runs.find_runs([], runs.Numbers()) == []


def test_catchers_know_a_run_when_its_word_has_come():
    """The stream can be asked after any word; what is caught then is what the words so far hold."""
    words = [b"x", b"y"] + [b"a", b"b", b"c"] * 6 + [b"z"] + [b"q"] * 14
    numbers = runs.Numbers()
    catchers = runs.SquareCatchers(len(words))
    for i, word in enumerate(words):
        catchers.append(np.array([numbers[word]]))
        assert list(map(tuple, catchers.runs().tolist())) == brute(words[:i + 1])


def expected(doc_id, text, plant):
    words = (text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    drawn = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and drawn % 10 == 0 and words:
        n, g = len(words), drawn // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    left = " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(left)), found, left


def test_detect_on_odd_texts(spark):
    rows = [(i, " ".join(t)) for i, t in enumerate(samples())]
    rows += [(None, "a b c " * 9), (900, None), (901, ""), (902, " \n\t"), (903, "é É x " * 10), (904, "a\x0bb\x0cc\r\n" * 5)] + [(20, "no no " * 8)] * 3
    rows += [(950 + i, f"w{i} " * 30) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "given": F.lit("x"), "N_runs": F.lit(0)})
    for plant in (runs.planted, None):
        truth = [expected(i, t, plant) for i, t in rows]
        got = runs.detect(df, alter=plant).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(repr(t[0]) for t in truth)
    told = runs.detect(df, with_text=True).collect()
    assert sorted(repr(([tuple(x) for x in r["runs"]], r["collapsed"])) for r in told) == sorted(repr((t[1], t[2])) for t in truth)
    assert runs.detect(df.limit(0)).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(9)
    text = [rng.choice("abcdefgh") + rng.choice("ijklmnop") for _ in range(90_000)]
    text[30_000:70_000] = (text[:13_333] * 4)[:40_000]
    found = runs.detect(spark.createDataFrame([(3, " ".join(text)), (4, "same " * 150_000)], "doc_id long, text string")).collect()
    by = {r["doc_id"]: r for r in found}
    assert (by[3]["start"], by[3]["length"], by[3]["period"]) == (30_000, 40_000, 13_333)
    assert (by[4]["n_runs"], by[4]["length"], by[4]["period"], by[4]["collapsed_sha256"]) == (
        1, 150_000, 1, hashlib.sha256(b"same").hexdigest())
