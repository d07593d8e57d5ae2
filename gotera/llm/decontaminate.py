"""Benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from gotera.llm.common import fresh, quoted, stored
from gotera.operators.skew import broadcast_if_small

WIDTH = 5
PERCENT = 80
SPACES = r"[\x20\x09-\x0D]+"


def shingled(df: DataFrame) -> DataFrame:
    """(content, shingle) of (content, text): lower-cased words joined by blanks, five at a time.

    A text of fewer than five words is one shingle; a text without words has none. Repeated shingles are not removed.
    """
    split = df.select("content", F.array_remove(F.split(F.lower("text"), SPACES), "").alias("words"))
    starts = F.greatest(F.size("words") - (WIDTH - 1), F.lit(1))
    rolled = split.where(F.size("words") > 0).select(
        "content", F.explode(F.arrays_zip(*[F.slice("words", i + 1, starts) for i in range(WIDTH)])).alias("w"))
    names = rolled.schema["w"].dataType.fieldNames()
    return rolled.select("content", F.concat_ws(" ", *[F.col("w").getField(f) for f in names]).alias("shingle"))


def contents(df: DataFrame, text: str) -> DataFrame:
    return df.select(F.md5(quoted(text)).alias("content"), quoted(text).alias("text")).where("text is not null")


def item_shingles(items: DataFrame, text: str, percent: int) -> DataFrame:
    """(item, shingle, mark, n_item, place, k, missing): the distinct shingles of each item text in MinHash order.

    Items are partitioned by size class (powers of two). ``k`` is the sketch length of the class, one more than the
    shingles that its largest item may miss at ``percent`` containment; ``missing`` is how many this item may miss.
    """
    known = shingled(contents(items, text).dropDuplicates(["content"])).distinct()
    marked = known.select(F.col("content").alias("item"), "shingle", F.xxhash64("shingle").alias("mark"))
    by_item = Window.partitionBy("item")
    sized = marked.withColumn("n_item", F.count("*").over(by_item)).withColumn(
        "place", F.row_number().over(by_item.orderBy("mark", "shingle")))
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.col("n_item").cast("double"))) + 1) - 1
    allowed = lambda n: F.floor(n * (100 - percent) / 100)
    return sized.withColumn("k", F.least(allowed(largest) + 1, F.col("n_item"))).withColumn(
        "missing", F.col("n_item") - F.ceil(F.col("n_item") * percent / 100))


def contained_items(docs: DataFrame, items: DataFrame, doc_text: str = "text", item_text: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """(content, item, n_item, n_shared): contents (md5) of documents that hold at least ``percent`` of an item's shingles.

    The sketch of an item is its k smallest shingle hashes. A document that holds ``percent`` of the item lacks at most
    ``missing`` of them, so it meets at least k - missing >= 1 sketch entries: the search by sketch loses nothing, and
    joins a fraction of the item shingles only. What it finds is verified on the full shingles, compared as words, for
    the documents found alone. Item size classes fix k, so the document's length plays no part and a short item is found
    inside a text of any length.

    The item side is broadcast behind a count, beyond it the joins are shuffled. Equal documents are one content.
    """
    full = stored(item_shingles(items, item_text, percent), "items")
    sketch = broadcast_if_small(full.where("place <= k").select("item", "mark", "k", "missing"))
    searched = shingled(contents(docs, doc_text)).select("content", F.xxhash64("shingle").alias("mark"))
    met = searched.join(sketch, "mark").distinct()
    candidates = stored(
        met.groupBy("content", "item").agg(F.count("*").alias("met"), F.first("k").alias("k"),
                                           F.first("missing").alias("missing"))
        .where("met >= k - missing").select("content", "item"), "candidates")
    wanted = broadcast_if_small(candidates.select("content").distinct())
    texts = contents(docs, doc_text).join(wanted, "content", "left_semi").dropDuplicates(["content"])
    held = shingled(texts).distinct()
    asked = candidates.join(full.select("item", "shingle", "n_item"), "item")
    return (
        asked.join(held, ["content", "shingle"]).groupBy("content", "item")
        .agg(F.first("n_item").alias("n_item"), F.count("*").alias("n_shared"))
        .where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    )


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id",
                  doc_text: str = "text", item_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc id, item id, n_item, n_shared, containment) for every row pair whose document holds the item.

    Null and empty texts hold nothing and are held by nothing. Repeated rows and equal texts each give their own pairs.
    Empty tables give none.
    """
    found = stored(contained_items(docs, items, doc_text, item_text, percent), "contained")
    named = items.select(quoted(item_id).alias("item_id"), F.md5(quoted(item_text)).alias("item"))
    pairs = found.join(named, "item")
    keyed = docs.select(quoted(doc_id).alias("doc_id"), F.md5(quoted(doc_text)).alias("content"))
    return keyed.join(pairs, "content").select(
        F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id), "n_item", "n_shared",
        (F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text",
                  percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose text holds no item; null, empty and blank texts stay.

    It is the text that decides: of rows with one id, those with clean texts stay; rows that repeat a text share its
    fate, and repeats stay repeated. An item held to exactly ``percent`` counts as held. Empty tables of documents or
    items drop nothing.
    """
    (content,) = fresh(docs.columns, "content")
    bad = stored(contained_items(docs, items, text, item_text, percent).select(
        F.col("content").alias(content)).distinct(), "contaminated")
    return docs.withColumn(content, F.md5(quoted(text))).join(broadcast_if_small(bad), content, "left_anti").drop(content)

