"""Secret scanning: three fixed kinds, and a randomness test battery under false-discovery control."""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from gotera.llm.common import LOWER, UPPER, fresh, quoted

# The base kinds, in their order, as (kind, pattern, group that is measured, least length of it).
# For access and hex the least length is part of the pattern, which leaves out the same matches.
BASE_KINDS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
RANDOM_KIND = "random"
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
DIGITS = "0123456789"
# Encodings tried in this order as (pattern, alphabet).
ENCODINGS = [
    (r"^[0-9]+$", DIGITS),
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[a-z]+$", LOWER),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[0-9a-z]+$", DIGITS + LOWER),
    (r"^[0-9A-Z]+$", DIGITS + UPPER),
    (r"^[A-Za-z]+$", UPPER + LOWER),
    (r"^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    (r"", UPPER + LOWER + DIGITS + "+/"),
]
SYMBOLS = LOWER + UPPER + DIGITS + "+/"
# Letters of English text in percent, a to z; what is known of letters without a corpus.
LETTER_PERCENT = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8,
                  0.98, 2.4, 0.15, 2.0, 0.074)
# The most frequent pairs of letters in English words, in ten thousandths of all pairs.
ENGLISH_PAIRS = """th 356 he 307 in 243 er 205 an 199 re 185 on 176 at 149 en 145 nd 135 ti 134 es 134 or 128 te 120 of 117 ed 117
is 113 it 112 al 109 ar 107 st 105 to 104 nt 104 ng 95 se 93 ha 93 as 87 ou 87 io 83 le 83 ve 83 co 79 me 79 de 76 hi 76 ri 73
ro 73 ic 70 ne 69 ea 69 ra 69 ce 65 li 62 ch 60 ll 58 be 58 ma 57 si 55 om 55 ur 54 ca 54 el 53 ta 53 la 53 ns 51 di 50 fo 49
ho 48 pe 48 ec 48 pr 47 no 47 ct 46 us 46 ac 45 ot 44 il 43 tr 43 ly 43 nc 42 et 42 ut 41 ss 41 so 40 rs 40 un 39 lo 39 wa 38
ge 38 ie 38 wh 38 ee 38 wi 37 em 37 ad 37 ol 37 rt 36 po 36 we 36 na 35 ul 35 ni 34 ts 34 mo 34 ow 33 pa 32 im 32 mi 32 ai 32
sh 32 ir 31 su 31 id 29 os 29 iv 29 ia 29 am 28 fi 28 ci 28 vi 26 pl 26 ig 25 tu 25 ev 25 ld 25 ry 25 mp 24 fe 24 bl 24 ab 24
gh 23 ty 23 op 23 wo 23 sa 22 ay 22 ex 21 ke 21 fr 21 oo 21 av 20 ag 20 if 20 ap 20 gr 20 od 19 bo 18 sp 18 rd 18 do 18 uc 17
bu 17 ei 17 ov 17 by 17 rm 16 ep 16 tt 16 oc 16 fa 16 ef 16 cu 16 rn 16 sc 15 gi 15 da 15 yo 15 cr 15 cl 15 du 14 ga 14 qu 14
ue 14 ff 14 ba 14 ey 13 ls 13 va 13 um 13 pp 12 ua 12 up 12 lu 12 go 12 ht 12 ru 12 ug 11 ds 11 lt 11 pi 11 rc 11 rr 11 eg 11
au 11 ck 11 ew 11 mu 11 br 11 bi 11 pt 11 ak 10 pu 10 ui 10"""
# How names and paths go on, as chances of (letter, digit, sign) after each, and of the letter's case: names
# have words of many letters, few digits that stand together, and humps.
AFTER = {"letter": (0.92, 0.04, 0.04), "digit": (0.25, 0.6, 0.15), "sign": (0.8, 0.15, 0.05)}
SAME_CASE = {"lower": 0.88, "upper": 0.7}
#: Corpus pairs that the letters' chances without a corpus count as, and how often a word must occur to be learned from.
PRIOR_PAIRS = 20.0
LOOSE = 0.3
LEAST_WORDS = 3
LONGEST_WORD = 19
LENGTH_EDGES = (20, 32, 48, 64)
BIN_WIDTH = 0.05
MOST_TOKENS = 2**63
FALSE_DISCOVERY_RATE = 0.01
BATTERY_LEVEL = 0.001
RUN = 1_000
SPAN = "array<struct<start:int,end:int,hit:string>>"


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches; texts without one cost a single search."""
    return F.when(text.rlike(pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def placed(gaps: Column, hits: Column) -> Column:
    """Matches with start and end (code points, end exclusive) from the texts between them.

    Lengths are added up in runs of a thousand matches and then over the runs, so a text with a million matches does
    not copy its growing result a million times.
    """
    pieces = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(
        F.length(g).alias("gap"), F.length(h).alias("long"), h.alias("hit")))

    def grow(acc: Column, piece: Column) -> Column:
        start = acc["upto"] + piece["gap"]
        end = start + piece["long"]
        return F.struct(end.alias("upto"), F.concat(acc["spans"], F.array(F.struct(
            start.alias("start"), end.alias("end"), piece["hit"].alias("hit")))).alias("spans"))

    def run(number: Column) -> Column:
        return F.aggregate(F.slice(pieces, number * RUN + 1, F.lit(RUN)),
                           F.struct(F.lit(0).alias("upto"), F.array().cast(SPAN).alias("spans")), grow)

    def join(acc: Column, part: Column) -> Column:
        moved = F.transform(part["spans"], lambda s: F.struct(
            (s["start"] + acc["upto"]).alias("start"), (s["end"] + acc["upto"]).alias("end"), s["hit"].alias("hit")))
        return F.struct((acc["upto"] + part["upto"]).alias("upto"),
                        F.concat(acc["parts"], F.array(moved)).alias("parts"))

    last = F.floor((F.size(hits) - 1) / RUN).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), run)
    whole = F.aggregate(runs, F.struct(F.lit(0).alias("upto"), F.array().cast(f"array<{SPAN}>").alias("parts")), join,
                        lambda acc: F.flatten(acc["parts"]))
    return F.when(F.size(hits) > 0, whole).otherwise(F.array().cast(SPAN))


def normal_below(z: Column) -> Column:
    """Chance that a standard normal value is below z, to seven decimals (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = F.lit(0.0)
    for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = t * (poly + c)
    tail = F.greatest(poly * F.exp(-z * z / 2) * 0.3989422804014327, F.lit(1e-9))
    return F.when(z > 0, 1 - tail).otherwise(tail)


def stepwise(tokens: Column, *steps) -> Column:
    """Each step adds fields to the structs of an array; a step reads the fields of those before it."""
    for step in steps:
        tokens = F.transform(tokens, step)
    return tokens


def with_fields(x: Column, **fields: Column) -> Column:
    for name, value in fields.items():
        x = x.withField(name, value)
    return x


def encoded(x: Column) -> Column:
    """The token's letters without padding, url-safe signs as plain ones, and the first encoding that fits."""
    body = F.translate(F.rtrim(F.regexp_replace(x["hit"], "=+$", "")), "-_", "+/")

    def first(pick) -> Column:
        return functools.reduce(lambda rest, e: F.when(body.rlike(e[0]), F.lit(pick(e))).otherwise(rest),
                                reversed(ENCODINGS[:-1]), F.lit(pick(ENCODINGS[-1])))

    return with_fields(x, body=body, alphabet=first(lambda e: e[1]))


def spelled(x: Column) -> Column:
    letters = F.array_remove(F.split(x["body"], ""), "")
    return with_fields(x, letters=letters, n=F.length(x["body"]).cast("double"), k=F.length(x["alphabet"]).cast("double"),
                       codes=F.transform(letters, lambda c: F.instr(x["alphabet"], c).cast("double")),
                       symbols=F.transform(letters, lambda c: F.instr(F.lit(SYMBOLS), c) - 1))


def measured(x: Column, costs: Column) -> Column:
    n, k, body, codes = x["n"], x["k"], x["body"], x["codes"]
    squares = F.aggregate(F.array_distinct(x["letters"]), F.lit(0.0), lambda acc, c: acc + F.pow(
        n - F.length(F.replace(body, c, F.lit(""))), F.lit(2.0)))
    mean = F.aggregate(codes, F.lit(0.0), lambda acc, v: acc + v) / n
    high = F.aggregate(codes, F.lit(0.0), lambda acc, v: acc + F.when(v * 2 > k, 1.0).otherwise(0.0))
    size = F.size(codes)
    left, right = F.slice(codes, F.lit(1), size - 1), F.slice(codes, F.lit(2), size - 1)
    turns = F.aggregate(F.zip_with(left, right, lambda a, b: F.when((a * 2 > k) != (b * 2 > k), 1.0).otherwise(0.0)),
                        F.lit(0.0), lambda acc, v: acc + v)
    products = F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    powers = F.aggregate(codes, F.lit(0.0), lambda acc, v: acc + v * v)
    before, after = F.slice(x["symbols"], F.lit(1), size - 1), F.slice(x["symbols"], F.lit(2), size - 1)
    named = F.aggregate(F.zip_with(before, after, lambda a, b: F.get(costs, a * len(SYMBOLS) + b)), F.lit(0.0), lambda acc, v: acc + v)
    return with_fields(x, chi=k / n * squares - n, mean=mean, high=high, runs=turns + 1, products=products, powers=powers,
                       named=named)


def judged(x: Column) -> Column:
    """``fits``: a random text would pass the battery; ``evidence``: -log10 of the chance that a name looks so random.

    The evidence compares the token's chance as a random text of its encoding with that as a name (``name_costs``). Under
    names the ratio has mean one, so it exceeds t with a chance of at most 1 / t, whatever the length; the tenfold choice
    of an encoding costs a factor of ten. Short tokens cannot reach strong evidence.
    """
    n, k, df = x["n"], x["k"], x["k"] - 1
    uneven = (F.pow(x["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    p_chi = 1 - normal_below(uneven)
    high, low = x["high"], n - x["high"]
    expected = 2 * high * low / n + 1
    spread = F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9))
    z_runs = F.when((high == 0) | (low == 0), F.lit(9.0)).otherwise((x["runs"] - expected) / F.sqrt(spread))
    variance = x["powers"] / n - x["mean"] * x["mean"]
    serial = (x["products"] / (n - 1) - x["mean"] * x["mean"]) / F.greatest(variance, F.lit(1e-9))
    two_sided = lambda z: 2 * (1 - normal_below(F.abs(z)))
    least = F.least(p_chi, two_sided(z_runs), two_sided(serial * F.sqrt(n)))
    even = x["named"] - (n - 1) * F.log10(k) - math.log10(len(ENCODINGS))
    usable = (k > len(DIGITS)) & (n >= LENGTH_EDGES[0])
    cell = F.lit(0)
    for i, edge in enumerate(LENGTH_EDGES):
        cell = F.when(n >= edge, i).otherwise(cell)
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit"), cell.alias("cell"),
                    usable.alias("usable"), (usable & (3 * least >= BATTERY_LEVEL)).alias("fits"),
                    F.when(usable, even).otherwise(F.lit(0.0)).alias("evidence"))


def random_tokens(df: DataFrame, text: str, out: str, costs: Column) -> DataFrame:
    """``out``: every long token with its test results."""
    hits, gaps, spans, spelt = fresh([*df.columns, out], "hits", "gaps", "spans", "spelt")
    body = quoted(text)
    return (
        df.withColumn(hits, matches(body, TOKEN))
        .withColumn(gaps, F.when(F.size(hits) > 0, F.split(body, TOKEN)))
        .withColumn(spans, placed(quoted(gaps), quoted(hits)))
        .withColumn(spelt, stepwise(quoted(spans), encoded, spelled))
        .withColumn(out, stepwise(quoted(spelt), lambda x: measured(x, costs), judged))
        .drop(hits, gaps, spans, spelt)
    )


def letter_pairs(df: DataFrame, text: str) -> dict[str, int]:
    """How many words of the corpus hold each pair of letters; all texts are read.

    Words are the plain ASCII words of 2 to 19 letters that occur at least three times, each counted once, so neither
    copies of a text nor random strings weigh. At most 676 counts reach the driver.
    """
    words = df.select(F.explode(F.split(quoted(text), r"[^A-Za-z0-9+/_=-]+")).alias("word")).where(
        F.col("word").rlike(f"^[A-Za-z]{{2,{LONGEST_WORD}}}$"))
    known = words.groupBy(F.lower("word").alias("word")).count().where(F.col("count") >= LEAST_WORDS)
    pairs = known.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(
        F.col("word"), i, F.lit(2)))).alias("pair"))
    return {r["pair"]: r["count"] for r in pairs.groupBy("pair").count().collect()}


def name_costs(pairs: Mapping[str, int]) -> list[float]:
    """-log10 of each symbol's chance after each other one in a name: entry 64 * first + second of ``SYMBOLS``.

    Within a word a letter follows the letter before it half as in the corpus (``pairs``) and half as in English words,
    both smoothed with the letters' general chances; a word starts at a hump, a digit or a sign. A share of the letters is
    loosely chosen everywhere, so that a few odd pairs in a name weigh little.
    """
    said = ENGLISH_PAIRS.split()
    english = dict(zip(said[::2], map(int, said[1::2])))
    share = {c: p / sum(LETTER_PERCENT) for c, p in zip(LOWER, LETTER_PERCENT)}
    loose = {c: share[c] / 2 + 1 / (2 * len(LOWER)) for c in LOWER}
    tables = [(known, {a: sum(known.get(a + b, 0) for b in LOWER) for a in LOWER}) for known in (pairs or english, english)]

    def kind(c: str) -> str:
        return "letter" if c.isalpha() else "digit" if c.isdigit() else "sign"

    def chance(a: str, b: str) -> float:
        go = AFTER[kind(a)][("letter", "digit", "sign").index(kind(b))]
        if kind(b) == "digit":
            return go / len(DIGITS)
        if kind(b) == "sign":
            return go / 2
        if kind(a) != "letter":
            return go / 2 * loose[b.lower()]
        stay = SAME_CASE["lower" if a.islower() else "upper"]
        if a.islower() and b.isupper():
            return go * (1 - stay) * loose[b.lower()]
        learned = [(known.get((a + b).lower(), 0) + PRIOR_PAIRS * share[b.lower()]) / (held[a.lower()] + PRIOR_PAIRS)
                   for known, held in tables]
        spelt = (1 - LOOSE) * sum(learned) / len(learned) + LOOSE * loose[b.lower()]
        return go * (stay if a.islower() == b.islower() else 1 - stay) * spelt

    return [-math.log10(chance(a, b)) for a in SYMBOLS for b in SYMBOLS]


def staged(df: DataFrame, text: str, out: str, spelling: Mapping[str, int]) -> tuple[DataFrame, dict[str, Column], str]:
    """The table with working columns: the spans of each base kind, and the long tokens that are no base secrets."""
    body, tokens, *parts = fresh([*df.columns, out], "body", "tokens", *[f"{k}_{w}" for k, *_ in BASE_KINDS
                                                                        for w in ("hits", "gaps", "spans")])
    made = df.withColumn(body, F.coalesce(quoted(text), F.lit("")))
    spans = {}
    for i, (kind, pattern, group, length) in enumerate(BASE_KINDS):
        hits, gaps, found = parts[3 * i:3 * i + 3]
        spans[kind] = quoted(found)
        made = (
            made.withColumn(hits, matches(quoted(body), pattern))
            .withColumn(gaps, F.when(F.size(hits) > 0, F.split(quoted(body), pattern)))
            .withColumn(found, F.filter(placed(quoted(gaps), quoted(hits)), lambda s: F.length(
                F.regexp_extract(s["hit"], pattern, group)) >= length))
        )
    costs = F.split(F.lit(",".join(f"{c:.6f}" for c in name_costs(spelling))), ",").cast("array<double>")

    def unknown(t: Column) -> Column:
        # hex and access letters are token letters, so a base match that meets a token lies inside it
        return ~(t["hit"].rlike(BASE_KINDS[1][1]) | t["hit"].rlike(BASE_KINDS[2][1]) | F.exists(
            spans["assign"], lambda a: (a["start"] < t["end"]) & (t["start"] < a["end"])))

    return random_tokens(made, body, tokens, costs).withColumn(tokens, F.filter(quoted(tokens), unknown)), spans, tokens


def thresholds(df: DataFrame, text: str, spelling: Mapping[str, int], rate: float = FALSE_DISCOVERY_RATE) -> list[float]:
    """Least evidence per length class by the Benjamini-Hochberg rule over the long tokens of all texts.

    The tests are the tokens that could be reported: base secrets and plain numbers are none. A token that fails the
    battery is a test of p = 1 and no discovery, any other has p = 10 ** -evidence; so the rate bounds the share of names
    among what is reported. Evidence is counted in bins, so what reaches the driver is one count per length class and
    bin, whatever the table. The bins reach as far as the rule can ask of a single token among as many as can be counted.
    """
    found, _, tokens = staged(df.select(quoted(text).alias("text")), "text", "secrets", spelling)
    bins = math.ceil(math.log10(MOST_TOKENS) - math.log10(max(rate, sys.float_info.min))) * round(1 / BIN_WIDTH)
    at = F.greatest(F.least(F.floor(F.col("t.evidence") / BIN_WIDTH), F.lit(bins)), F.lit(0)).cast("int")
    counts = (
        found.select(F.explode(tokens).alias("t")).where("t.usable")
        .groupBy(F.col("t.cell").alias("cell"), F.when(F.col("t.fits"), at).otherwise(F.lit(0)).alias("bin")).count().collect()
    )
    return benjamini_hochberg([(r["cell"], r["bin"], r["count"]) for r in counts], rate)


def benjamini_hochberg(counts: list[tuple[int, int, int]], rate: float) -> list[float]:
    """Per class: the weakest bin whose lower edge p satisfies p <= rate * (tokens at least as strong) / tokens."""
    out = []
    for cell in range(len(LENGTH_EDGES)):
        bins = {b: n for c, b, n in counts if c == cell}
        total, strong, least = sum(bins.values()), 0, float("inf")
        for b in sorted(bins, reverse=True):
            strong += bins[b]
            if 10 ** -(b * BIN_WIDTH) <= rate * strong / total:
                least = b * BIN_WIDTH
        out.append(least)
    return out


def find_secrets(df: DataFrame, text: str = "text", out: str = "secrets", rate: float = FALSE_DISCOVERY_RATE,
                 least: list[float] | None = None, spelling: Mapping[str, int] | None = None) -> DataFrame:
    """Every row with ``out``: its secrets as (kind, start, end), by start, then kind; code points, end exclusive.

    Base kinds are fixed patterns. Kind ``random``: long tokens that pass chi-squared uniformity over the alphabet of
    their inferred encoding, a runs test and a lag-one serial correlation test (so random text explains them), and that a
    name made of the corpus' letter pairs does not explain at the false-discovery rate ``rate`` in their length class.
    Tokens that overlap a base secret, and plain numbers, are left out. ``spelling`` takes letter pairs and ``least``
    thresholds fitted before; without them both are fitted on all texts.

    Null and empty texts have no secrets. Rows are only projected, none is moved. A column named ``out`` is replaced.
    """
    spelling = letter_pairs(df, text) if spelling is None else spelling
    least = thresholds(df, text, spelling, rate) if least is None else least
    kept = [c for c in df.columns if c.lower() != out.lower()]
    made, spans, tokens = staged(df.select(*[quoted(c) for c in kept]), text, out, spelling)

    def flagged(t: Column) -> Column:
        bound = functools.reduce(lambda rest, i: F.when(t["cell"] == i, F.lit(float(least[i]))).otherwise(rest),
                                 range(1, len(least)), F.lit(float(least[0])))
        return t["fits"] & (t["evidence"] >= bound)

    every = [(kind, spans[kind]) for kind, *_ in BASE_KINDS] + [(RANDOM_KIND, F.filter(quoted(tokens), flagged))]
    ordered = F.array_sort(F.concat(*[F.transform(found, lambda s: F.struct(
        s["start"].alias("start"), F.lit(i).alias("turn"), s["end"].alias("end"))) for i, (_, found) in enumerate(every)]))
    names = F.array(*[F.lit(kind) for kind, _ in every])
    return made.select(*[quoted(c) for c in kept], F.transform(ordered, lambda s: F.struct(
        F.get(names, s["turn"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias(out))


def digest(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans share one mark."""
    def cut(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["upto"]
        piece = F.when(inside, F.lit("")).otherwise(
            F.concat(F.substring(text, acc["upto"] + 1, s["start"] - acc["upto"]), F.lit(mark)))
        return F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"),
                        F.concat(acc["parts"], F.array(piece)).alias("parts"))

    rest = lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["upto"] + 1, F.length(text)))
    start = F.struct(F.lit(0).alias("upto"), F.array().cast("array<string>").alias("parts"))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, cut, rest)).otherwise(text)
