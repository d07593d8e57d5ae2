import base64
import gzip
import glob
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from gotera.llm import bpe, language, warc
from gotera.llm.common import run_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_text(rng, size):
    parts = ["don't", "'s", " ", "\n\n  ", "\t", "é", "😀", "123abc", "a1", "...", "ß", "x" * 40, "\u3000", "<|endoftext|>", "\x00", "\x1c "]
    return "".join(rng.choice(parts) for _ in range(size))


def test_pieces_keep_the_ids(coder, monkeypatch):
    monkeypatch.setattr(bpe, "LONG", 50)
    monkeypatch.setattr(bpe, "STEP", 20)
    rng = random.Random(2)
    for _ in range(300):
        text = odd_text(rng, 60)
        parts = list(bpe.pieces(text))
        assert "".join(parts) == text and sum((coder.encode_ordinary(p) for p in parts), []) == coder.encode_ordinary(text)


def test_encode_and_decode(spark, coder):
    rng = random.Random(3)
    given = [None, "", *[odd_text(rng, 30) for _ in range(50)], "long words here " * 20_000, "y" * 120_000]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").withColumn("ranks", F.lit("kept"))
    coded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    for r in bpe.decode(coded, RANKS, public_tokenizers.PATTERN).collect():
        text = given[r["doc_id"]] or ""
        assert r["ids"] == coder.encode_ordinary(text) and bytes(r["decoded"]) == text.encode() and r["ranks"] == "kept"
    assert bpe.encode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    cut = spark.createDataFrame([(1, coder.encode_ordinary("é")[:1]), (2, None), (3, [])], "k long, ids array<int>")
    got = {r["k"]: r["decoded"] for r in bpe.decode(cut, RANKS, public_tokenizers.PATTERN).collect()}
    assert got[2] is None and bytes(got[3]) == b""


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("0.001", "0.01") + "/documents.parquet")
    known = language.learn(docs.where(~language.held_out(F.col("doc_id"))))
    assert set(known) == {"en", "fr", "de", "es"} and max(map(len, known.values())) <= language.DICTIONARY_BYTES
    judged = language.identify(docs.where(language.held_out(F.col("doc_id"))), known)
    right, n, rejected = judged.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"),
                                    F.sum(F.col("rejected").cast("int"))).first()
    assert right / n > 0.93 and rejected / n < 0.03


def test_copies_take_one_place_of_the_sample(spark):
    texts = sorted((f"text {chr(97 + i)}" for i in range(10)), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    rows = [(t, "en") for t in texts[:1] * 300 + texts[1:] + texts[1:]]
    known = language.learn(spark.createDataFrame(rows, "text string, lang string"), rows=5)
    assert known == {"en": "\n".join(texts[:5]).encode()}


def test_language_of_odd_texts(spark):
    given = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "123 !?", None), (4, "hello there", None)],
                                  "doc_id long, text string, score string")
    known = {"en": b"hello there is the word of the day", "fr": b"bonjour le monde et la ville"}
    got = {r["doc_id"]: r for r in language.identify(given, known).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and got[4]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[1]["rejected"] and not got[4]["rejected"]
    assert language.identify(given, {}).where("lang_pred <> 'und'").count() == 0
    assert language.identify(given, {"xx": b"a"}).where("doc_id = 4").first()["score"] == 1.0
    assert language.learn(spark.createDataFrame([(None, "en"), ("a", None), ("7", "en")], "text string, lang string")) == {}


def test_language_of_long_and_repeated_texts(spark):
    known = {"en": b"hello there is the word of the day and the night", "fr": b"bonjour le monde et la ville de la nuit"}
    long = "bonjour le monde et la ville " * 30_000
    given = spark.createDataFrame([(1, long, "x"), (2, "hello there", "x"), (2, "hello there", "x"), (None, "hello there", None)],
                                  "doc_id long, text string, Rejected string")
    got = sorted(((r["doc_id"] or 0, r["lang_pred"], r["text"] == long) for r in language.identify(given, known).collect()))
    assert got == [(0, "en", False), (1, "fr", True), (2, "en", False), (2, "en", False)]
    renamed = given.withColumnRenamed("text", "body").withColumn("text", F.lit("bonjour la ville"))
    assert {r["lang_pred"] for r in language.identify(renamed, known, text="body").where("doc_id = 2").collect()} == {"en"}
    assert language.identify(given.limit(0), known).count() == 0


def test_archives_of_no_pages(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, f"{tmp_path}/w")
    assert warc.read_pages(spark, f"{tmp_path}/w").count() == 0


def test_chunks_and_cuts():
    rng = random.Random(8)
    for _ in range(100):
        data = odd_text(rng, rng.randrange(40)).encode()
        assert b"".join(warc.cuts(data, 7)) == data and all(p.decode() or True for p in warc.cuts(data, 7))
        assert warc.unchunked(warc.chunked(data)) == data
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def expected(rows):
    first = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 100 and page is not None:
            first[html] = min(first.get(html, page), page)
    count = {}
    for _, _, html in rows:
        count[html] = count.get(html, 0) + 1
    out = []
    for page, _, html in rows:
        f = first.get(html) if count[html] > 1 else None
        again = f is not None and f != page
        data = (html or "").encode()
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(map(repr, out))


def test_warc_round_trip(spark):
    rng = random.Random(6)
    long = odd_text(rng, 30_000)
    rows = [(1, "http://a/", None), (2, "http://b/ c\r\n", ""), (3, None, "x" * 99), (4, "u", "x" * 99), (5, "u", "WARC/1.1\r\n\r\n" * 20),
            (6, "u", "WARC/1.1\r\n\r\n" * 20), (7, "u", long), (9, "v", long), (None, "w", long), (7, "u", long), (None, "n", "q" * 200)]
    rows += [(100 + i, "u", "é" * 150) for i in range(40)] + [(200 + i, "u", f"page {i} " * 3_000) for i in range(5)]
    path = run_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path,
                        segment_bytes=500, records_per_file=50)
    assert sorted(repr(tuple(r)) for r in warc.read_pages(spark, path).collect()) == expected(rows)
    kinds = {r["record_type"]: r["n"] for r in warc.read_records(spark, path).groupBy("record_type").agg(F.count("*").alias("n")).collect()}
    assert kinds["continuation"] > 100 and kinds["revisit"] == 42
    data = gzip.open(glob.glob(path.removeprefix("file:") + "/part-*.gz")[0]).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")


def test_a_lost_segment_is_noticed(spark):
    path = run_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([(1, "u", "abc" * 1_000)], "page_id long, url string, html string"), path, segment_bytes=500)
    found = warc.read_records(spark, path).where("coalesce(segment, 0) <> 3")
    with pytest.raises(Exception, match="not whole"):
        warc.payloads(found).collect()
