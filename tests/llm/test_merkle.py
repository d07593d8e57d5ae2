import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gotera.llm import merkle, registry

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def level_up(nodes):
    return [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]


def path(nodes, at):
    """(sibling or None, whether it is left) of each level above node ``at``, and the last node."""
    out = []
    while len(nodes) > 1:
        out.append((nodes[at ^ 1] if at ^ 1 < len(nodes) else None, at % 2 == 1))
        nodes, at = level_up(nodes), at // 2
    return out, nodes[0]


def truth(rows, tampered):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, h(*map(said, row)), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for held in groups.values():
        held.sort(key=lambda e: e[:3])
    subroots = [path([e[2] for e in groups[g]], 0)[1] for g in names]
    out = []
    for number, g in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(groups[g]):
            low, subroot = path([e[2] for e in groups[g]], at)
            high, root = path(subroots, number)
            folded = leaf
            if tampered(row):
                changed = list(row)
                changed[3] = None if row[3] is None else row[3] + 1
                folded = h(*map(said, changed))
            for sibling, left in low + high:
                folded = h(sibling or "", folded) if left else h(folded, sibling or "")
            proof = h(*[s for s, _ in low + high if s])
            out.append((row[0], leaf, subroot, root, proof, folded, folded == root))
    return sorted(map(repr, out))


def proved(spark, rows, tampered, **given):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumns({"Digest": F.lit(1), "part": F.lit(2), "pos": F.lit("p"), "given_key": F.lit(3), "tree": F.lit(0)})
    more = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    return sorted(repr(tuple(r)) for r in merkle.prove(df, FIELDS, more, tampered, **given).collect())


def example():
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "ü", "", None]), rng.choice(["en"] * 5 + ["de", "é", "", None]), rng.choice([0, 9, 10, 2**63 - 1, None]),
             rng.choice(["", "x", "long " * 400, "abé", None])) for i in range(150)]
    rows += [(7, "a", "en", 1, "again")] * 40 + [(7, "a", "en", 2, "again")] + [(None, "b", "en", 1, "t")] * 3 + [(None, None, None, None, None)]
    rows += [(1_000, "s", "lone", 4, "x" * 300_000), (-5, "s", "en", -1, "y")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("span", [1, 3, 10])
def test_every_proof_matches_brute_force(spark, span):
    rows = example()
    got = proved(spark, rows, F.col("doc_id") % 3 == 0, span=span)
    assert got == truth(rows, lambda r: r[0] is not None and r[0] % 3 == 0)


def test_shuffled_climb_is_the_broadcast_one(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", -1)
    rows = example()[:60]
    assert proved(spark, rows, F.col("n_chars") > 5, span=1) == truth(rows, lambda r: r[3] is not None and r[3] > 5)


def test_small_tables(spark):
    never = F.lit(None).cast("boolean")
    for rows in ([], [(1, "a", "en", 3, "x")], [(2, None, None, None, None), (1, "a", "en", 3, "x")], [(1, "a", "en", 3, "x")] * 2):
        assert proved(spark, rows, never) == truth(rows, lambda r: False)
    lone = merkle.prove(spark.createDataFrame([(1, "a", "en", 3, "x")], "doc_id long, source string, lang string, n_chars long, text string"),
                        FIELDS, {}, never).first()
    assert lone["leaf"] == lone["subroot"] == lone["root"] and lone["proof_sha256"] == h() and lone["verified"]


def test_only_tampered_rows_fail(spark):
    found = registry.op11_merkle_manifest(spark, "/root/testdata/sf0.001")
    wrong = (F.crc32(F.col("doc_id").cast("string")) % 7 == 0) == F.col("verified")
    assert found.count() == 200 and found.where(wrong).count() == 0
