"""Language identification by compression against per-language zstandard dictionaries."""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from gotera.llm.bpe import weighed
from gotera.llm.common import beside_text, mapped, quoted
from gotera.operators.skew import smallest_per_group

SAMPLE_ROWS = 200
EXCERPT_CHARS = 400
DICTIONARY_BYTES = 64_000
WINDOW_BYTES = 4_096
LEVEL = 7
LEAST_MARGIN = 0.001
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id's text leaves 2 by 4. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS,
          size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A raw-content dictionary per language of ``labelled``, the most frequent language first.

    The sample is bounded: of each language the ``rows`` distinct texts with the smallest md5, an excerpt of 400 characters from a
    hashed place of each, up to ``size`` bytes. So languages * 64 kB reach the driver and the executors, whatever the
    table. Rows with a null text or language, or without a letter, are left out. Rows are ranked in two steps, so a
    language with most of the rows is not gathered in one task.
    """
    body = quoted(text)
    start = 1 + F.pmod(F.xxhash64(body), F.greatest(F.length(body) - EXCERPT_CHARS, F.lit(1)).cast("bigint")).cast("int")
    learned = labelled.where(body.isNotNull() & quoted(lang).isNotNull() & body.rlike(r"\p{L}"))
    usable = learned.select(
        quoted(lang).cast("string").alias("lang"), F.md5(body).alias("mark"),
        F.lower(F.substring(body, start, F.lit(EXCERPT_CHARS))).alias("excerpt"))
    found: dict[str, list[tuple[str, str]]] = {}
    chosen = smallest_per_group(usable.select("lang", "mark").distinct(), ["lang"], "mark", rows)
    for row in usable.join(F.broadcast(chosen), ["lang", "mark"]).dropDuplicates(["lang", "mark"]).collect():
        found.setdefault(row["lang"], []).append((row["mark"], row["excerpt"]))
    rows_of = {r["lang"]: r["count"] for r in learned.groupBy(quoted(lang).cast("string").alias("lang")).count().collect()}
    return {name: "\n".join(excerpt for _, excerpt in sorted(found[name])).encode()[:size]
            for name in sorted(found, key=lambda n: (-rows_of.get(n, 0), n))}


def compressors(dictionaries: dict[str, bytes], level: int) -> list:
    import zstandard

    settings = zstandard.ZstdCompressionParameters.from_level(
        level, window_log=17, write_content_size=0, write_checksum=0, write_dict_id=0)
    made = []
    for content in dictionaries.values():
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=settings)
        made.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))
    return made


def classify(text: str | None, names: list[str], coders: list, least_margin: float) -> tuple[str, float, bool]:
    """Language, margin and whether the margin is too narrow. The margin is how much smaller the best size is than the next."""
    if not text or not names or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    if len(names) == 1:
        return names[0], 1.0, False
    data = text.lower().encode("utf-8", "surrogatepass")
    windows = [data[i:i + WINDOW_BYTES] for i in range(0, len(data), WINDOW_BYTES)]
    sizes = sorted((sum(len(coder.compress(w)) for w in windows), place) for place, coder in enumerate(coders))
    (best, place), (second, _) = sizes[:2]
    margin = (second - best) / second
    return names[place], margin, margin < least_margin


def identify(df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", least_margin: float = LEAST_MARGIN,
             level: int = LEVEL) -> DataFrame:
    """Every row with ``lang_pred``, ``score`` (the relative margin, 0 to 1) and ``rejected``.

    Every window of 4 kB of the whole lower-cased text is compressed with each language's dictionary; the language of the
    smallest total is chosen, ties go to the more frequent one. Windows keep a long text from teaching the compressor more than the
    dictionary does. A text is rejected where the margin is under ``least_margin``, where it is null or has no letter
    (``und``, score 0), and where no language was learned. Rows stay in their partitions; columns of these names are
    replaced.
    """
    made = ("lang_pred", "score", "rejected")
    kept = [c for c in df.columns if c.lower() not in made]
    source, at = beside_text(df, kept, text)
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches):
        names, coders = list(shared.value), compressors(shared.value, level)
        for batch in weighed(batches, at):
            found = [classify(value.as_py(), names, coders, least_margin) for value in batch.column(at)]
            columns = [pa.array(list(c), type=t) for c, t in zip(zip(*found), (pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *columns], names=[*kept, *made])

    return mapped(source, run, df.select(*[quoted(c) for c in kept]).schema.add("lang_pred", "string").add("score", "double").add(
        "rejected", "boolean"))
