"""N-gram Jaccard join: all documents whose word shingle sets are similar, by T-occurrence search with DivideSkip."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gotera.llm.bpe import weighed
from gotera.llm.common import Scratch, fresh, mapped, quoted, stored
from gotera.llm.components import connected
from gotera.operators.skew import broadcast_if_small

WIDTH = 5
PERCENT = 80
#: Shared prefix tokens that a pair has at least: a twentieth of the set, and 16 where the set is large enough.
LEAST_SHARED, SHARE = 16, 20
CELL_DOCS = 2_048
CELL_SHINGLES = 500_000
OWN_DOCS = 16
KNOWN_WORDS = 100_000
KNOWN_SETS = 200_000
#: Postings that are packed into one batch, and how often a batch holds a token that is dealt to ``DEALS`` tasks.
PACKED = 100_000
OFTEN = 16
DEALS = 64
#: Rows of a few numbers (some 100 bytes each once broadcast) up to which a side is broadcast.
BROADCAST_ROWS = 250_000
DIVIDE_MU = 0.01
#: Pairs of a list and a candidate that are probed at once.
PROBED = 1 << 20


class WordHashes(dict):
    """64-bit hashes of words; forgotten when there are many, so memory stays bounded."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, words: WordHashes, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``width``-word shingles (all words as one where there are fewer).

    Words are cut at ASCII white space, A-Z lower-cased: what ``bytes.lower`` and ``bytes.split`` do.
    """
    said = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not said:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(words.__getitem__, said), np.uint64, len(said))
    taken = min(width, len(codes))
    starts = len(codes) - taken + 1
    mixed = np.full(starts, taken, np.uint64)
    for i in range(taken):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[i:i + starts]
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def at_least(n: int, percent: int) -> int:
    """What a set of n shares at least with any set that is similar to it."""
    return (percent * n + 99) // 100


def shared_at_least(n: int, percent: int) -> int:
    return min(at_least(n, percent), max(LEAST_SHARED, -(-n // SHARE)))


def lowest_shared_column(n: Column, percent: int) -> Column:
    """What a set of n shares at least of its posted hashes with any similar set (one less for what rounding can take).

    Similar sets of n and m share o = percent / (100 + percent) of n + m or more. For any k, they then share k of their
    n - o + k and m - o + k smallest hashes, and both posted prefixes reach that far for k up to the smaller l.
    """
    least = F.least(F.floor((n * percent + 99) / 100), F.greatest(F.lit(LEAST_SHARED), F.ceil(n / SHARE)))
    return F.greatest(F.lit(1), least - 1).cast("bigint")


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a set."""
    import xxhash

    return int.from_bytes(xxhash.xxh3_64_digest(tokens.tobytes()), "little", signed=True)


def set_rows(df: DataFrame, text: str, key: str, width: int, percent: int) -> DataFrame:
    """(id, text_hash, n, cls, posted) of every row: its set's size and name, and on the first row of the task that has
    the set, its smallest shingle hashes as bytes, n - T + l of them.

    T = percent of n is what two similar sets share at least. By position, two sets that share T or more share at least l
    of their n - T + l smallest hashes, l being the smaller of theirs.
    """
    source = df.select(quoted(key).alias("id"), F.xxhash64(quoted(text)).alias("text_hash"), quoted(text).alias("text"))
    schema = T.StructType([source.schema["id"], T.StructField("text_hash", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("cls", T.LongType()), T.StructField("posted", T.BinaryType())])

    def run(batches):
        words, seen = WordHashes(), set()
        for batch in weighed(batches, 2):
            sets = [shingles(v.as_py(), words, width) for v in batch.column(2)]
            names = [class_of(s) for s in sets]
            if len(seen) > KNOWN_SETS:
                seen.clear()
            told = []
            for name, found in zip(names, sets):
                n = len(found)
                smallest = found[:n - at_least(n, percent) + shared_at_least(n, percent)]
                told.append(smallest.tobytes() if n and name not in seen else None)
                seen.add(name)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                 pa.array(told, pa.binary())], names=schema.names)

    return mapped(source, run, schema)


def hashes_of(value) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.uint64)


def postings(sets: DataFrame) -> DataFrame:
    """(token, deal, cls) of the posted hashes of (cls, posted).

    A token that a batch holds many times is known to be shared: two of its postings go the usual way (deal 0, which
    tells that the token is shared to postings elsewhere), the others are dealt to many tasks by their class.
    """
    def run(batches):
        def packed(held: list[np.ndarray], owners: list[int]) -> pa.RecordBatch:
            token = signed(np.concatenate(held))
            cls = np.repeat(np.array(owners, np.int64), [len(h) for h in held])
            order = np.argsort(token, kind="stable")
            token, cls = token[order], cls[order]
            starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            sizes = np.diff(np.r_[starts, len(token)])
            place = np.arange(len(token)) - np.repeat(starts, sizes)
            spread = (np.repeat(sizes, sizes) >= OFTEN) & (place >= 2)
            deal = np.where(spread, 1 + cls.view(np.uint64) % np.uint64(DEALS), np.uint64(0)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(token), pa.array(deal), pa.array(cls)], names=["token", "deal", "cls"])

        for batch in weighed(batches, 1):
            held, owners, size = [], [], 0
            for owner, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.append(hashes_of(value))
                owners.append(owner)
                size += len(held[-1])
                if size >= PACKED:
                    yield packed(held, owners)
                    held, owners, size = [], [], 0
            if held:
                yield packed(held, owners)

    return mapped(sets, run, "token bigint, deal int, cls bigint")


def whole_sets(df: DataFrame, text: str, width: int, wanted: DataFrame) -> DataFrame:
    """(cls, tokens): the whole sets, as bytes, of the texts whose ``text_hash`` is wanted."""
    source = df.select(F.xxhash64(quoted(text)).alias("text_hash"), quoted(text).alias("text")).join(
        broadcast_if_small(wanted, BROADCAST_ROWS), "text_hash", "left_semi")

    def run(batches):
        words, seen = WordHashes(), set()
        for batch in weighed(batches, 1):
            if len(seen) > KNOWN_SETS:
                seen.clear()
            fresh_ones = []
            for i, mark in enumerate(batch.column(0).to_pylist()):
                if mark not in seen:
                    seen.add(mark)
                    fresh_ones.append(i)
            sets = [shingles(batch.column(1)[i].as_py(), words, width) for i in fresh_ones]
            yield pa.RecordBatch.from_arrays([pa.array([class_of(s) for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "tokens"])

    return mapped(source, run, "cls bigint, tokens binary").dropDuplicates(["cls"])


def shared_only(rows: DataFrame) -> DataFrame:
    """(token, cls) whose token another cls has too; one pass over the sorted rows, holding one batch.

    Rows come once for each deal of their token, so at most a few times; a token held by a third of all sets is spread
    over many tasks, of which that of deal 0 gets two postings of a batch that holds it often.
    """
    def run(batches):
        last: tuple[int, int, int, bool] | None = None
        for batch in batches:
            token, deal, cls = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            if not len(token):
                continue
            if last:
                token, deal, cls = (np.r_[np.int64(v), column] for v, column in zip(last, (token, deal, cls)))
            group = (token[1:] != token[:-1]) | (deal[1:] != deal[:-1])
            new = np.r_[True, group | (cls[1:] != cls[:-1])]
            token, deal, cls = token[new], deal[new], cls[new]
            same = (token[1:] == token[:-1]) & (deal[1:] == deal[:-1])
            emit = np.r_[False, same] | np.r_[same, False] | (deal > 0)
            given = bool(last and last[3])
            last = (int(token[-1]), int(deal[-1]), int(cls[-1]), bool(emit[-1]) or (given and len(token) == 1))
            if given:
                emit[0] = False
            if emit.any():
                yield pa.RecordBatch.from_arrays([pa.array(token[emit]), pa.array(cls[emit])], names=["token", "cls"])

    order = ["token", "deal"]
    return mapped(rows.repartition(*order).sortWithinPartitions(*order, "cls"), run, "token bigint, cls bigint")


def merge_skip(lists: list[list[int]], need: int) -> tuple[list[int], list[int]]:
    """Members of at least ``need`` of the sorted lists, and in how many they are, by a heap that skips what cannot be.

    The heap holds the head of every list. Lists whose heads are equal are taken off together; where they are too few,
    more are taken off until need - 1 are out, and all of them skip, by binary search, to the head that is then on top:
    nothing before it can stand in ``need`` lists.
    """
    found, counts, many = [], [], len(lists)
    heap = [held[0] * many + i for i, held in enumerate(lists)]
    heapq.heapify(heap)
    at = [0] * many
    while len(heap) >= need:
        top = heap[0] // many
        beyond = (top + 1) * many
        popped = []
        while heap and heap[0] < beyond:
            popped.append(heapq.heappop(heap) % many)
        floor = top + 1
        if len(popped) >= need:
            found.append(top)
            counts.append(len(popped))
        else:
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap) % many)
            if not heap:
                break
            floor = max(heap[0] // many, floor)
        for i in popped:
            held, place = lists[i], at[i]
            if held[place] < floor:
                place = bisect_left(held, floor, place + 1)
            if place < len(held):
                at[i] = place
                heapq.heappush(heap, held[place] * many + i)
    return found, counts


def set_aside(longest: int, need: int) -> int:
    """DivideSkip's rule: how many of the longest lists are probed instead of merged."""
    return min(need - 1, int(need / (DIVIDE_MU * math.log2(longest + 1) + 1)))


def divide_skip(keys: np.ndarray, count: int, starts: np.ndarray, ends: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """T-occurrence: members of at least ``need`` of the sorted lists, and in how many they are.

    ``keys`` are list number * count + member, sorted, and a list is a slice of them. The longest lists are set aside;
    the short ones are merged by a heap for what stands in at least need minus as many, and what is found is looked up
    in the lists set aside by binary search.
    """
    sizes = ends - starts
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(sizes) < need:
        return none
    order = np.argsort(-sizes, kind="stable")
    aside = set_aside(int(sizes[order[0]]), need)
    short = order[aside:]
    upto = np.cumsum(sizes[short])
    before = upto - sizes[short]
    members = (keys[np.repeat(starts[short] - before, sizes[short]) + np.arange(upto[-1])] % count).tolist()
    found, counts = (np.array(c, np.int64) for c in merge_skip(
        [members[i:j] for i, j in zip(before.tolist(), upto.tolist())], need - aside))
    done = 0
    while done < aside and len(found):
        base = keys[starts[order[done:min(aside, done + max(1, PROBED // len(found)))]]] // count * count
        wanted = base[:, None] + found[None, :]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        counts = counts + (keys[at] == wanted).sum(axis=0)
        done += len(base)
        hopeful = counts + (aside - done) >= need
        found, counts = found[hopeful], counts[hopeful]
    return found[counts >= need], counts[counts >= need]


class CellIndex:
    """Inverted lists of the whole sets of a cell's documents (cls, comp, tokens), as slices of one sorted array."""

    def __init__(self, docs: list[tuple[int, int, np.ndarray]], percent: int):
        self.docs, self.sizes = docs, Counter(d[1] for d in docs)
        self.n = np.array([len(d[2]) for d in docs], np.int64)
        self.count, self.percent = len(docs), percent
        tokens = np.concatenate([d[2] for d in docs]) if docs else np.zeros(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]][:len(tokens)])
        self.tokens, self.ends = tokens[first], np.r_[first, len(tokens)]
        number = np.repeat(np.arange(len(first)), np.diff(self.ends))
        self.keys = number * self.count + np.repeat(np.arange(len(docs)), self.n)[order]

    def without(self, comp: int) -> CellIndex:
        return CellIndex([d for d in self.docs if d[1] != comp], self.percent)

    def similar(self, whole: np.ndarray) -> np.ndarray:
        """Numbers of the documents that are similar to the asking one, the most alike first."""
        at = np.searchsorted(self.tokens, whole)
        here = at < len(self.tokens)
        at = at[here][self.tokens[at[here]] == whole[here]]
        found, met = divide_skip(self.keys, self.count, self.ends[at], self.ends[at + 1], at_least(len(whole), self.percent))
        linked = 100 * met >= self.percent * (len(whole) + self.n[found] - met)
        return found[linked][np.argsort(-met[linked], kind="stable")]


def search_cells(percent: int):
    """Streams cells sorted with their indexed documents first; each asking document is searched in the cell's lists.

    A link joins two components for the rest of the cell, so of the links between two components one is given, and who is
    joined with all documents of the cell asks no more. Links inside a component change nothing: where ``OWN_DOCS`` or
    more documents of the asking one's component are indexed, it is searched in lists without them.
    """
    def run(batches):
        cell, docs, index, others, label, roots = None, [], None, (None, None), {}, set()

        def root(comp: int) -> int:
            while label.get(comp, comp) != comp:
                comp = label[comp]
            return comp

        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for i, (lead, part, turn, cls, comp) in enumerate(zip(*columns)):
                if (lead, part) != cell:
                    cell, docs, index, others, label = (lead, part), [], None, (None, None), {}
                if turn == 0:
                    docs.append((cls, comp, hashes_of(batch.column(5)[i])))
                    continue
                if not docs:  # a part of a few very long documents can hold none of them
                    continue
                if index is None:
                    index = CellIndex(docs, percent)
                    roots = set(index.sizes)
                if roots == {root(comp)}:
                    continue
                if index.sizes[comp] >= OWN_DOCS and others[0] != comp:
                    others = comp, index.without(comp)
                searched = others[1] if others[0] == comp else index
                for number in searched.similar(hashes_of(batch.column(5)[i])).tolist():
                    mine, theirs = root(comp), root(searched.docs[number][1])
                    if mine != theirs:
                        found.append((cls, searched.docs[number][0]))
                        label[max(mine, theirs)] = min(mine, theirs)
                        roots -= {mine, theirs}
                        roots.add(min(mine, theirs))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.int64()) for i in range(2)], names=["a", "b"])

    return run


def parts_of(number: Column, shingles: Column) -> Column:
    """Parts of a cell: documents and shingles that are indexed together are bounded."""
    return F.greatest(F.ceil(number / CELL_DOCS), F.ceil(shingles / CELL_SHINGLES)).cast("int")


def own_part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("cls"), parts.cast("bigint")).cast("int")


def met_in_cells(visits: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) found in the cells of ``visits`` (lead, part, turn, cls, comp); turn 0 is indexed, turn 1 asks."""
    cells = visits.join(sets, "cls").select("lead", "part", "turn", "cls", "comp", "tokens")
    return mapped(cells.repartition("lead", "part").sortWithinPartitions("lead", "part", "turn", "comp"), search_cells(percent),
                  "a bigint, b bigint")


def led(star: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links (a, b) of each lead: it asks in the lists of the classes that ``star`` (lead, cls, n) brings to it."""
    cells = star.groupBy("lead").agg(parts_of(F.count("*"), F.sum("n")).alias("parts"))
    indexed = star.join(cells, "lead").select("lead", own_part(F.col("parts")).alias("part"), F.lit(0).alias("turn"), "cls")
    asking = cells.select("lead", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("turn"),
                          F.col("lead").alias("cls"))
    visits = indexed.unionByName(asking).withColumn("comp", F.col("cls"))
    return met_in_cells(visits, sets_of(star.select(F.explode(F.array("lead", "cls")).alias("cls")).distinct()), percent)


def across(posted: DataFrame, classes: DataFrame, labels: DataFrame, percent: int, sets_of, scratch: Scratch) -> DataFrame:
    """Links (a, b) between classes of different components, found by DivideSkip on the whole sets of a cell.

    ``sets_of`` gives (cls, tokens), the whole sets, of a table of classes.

    Links inside a component change nothing, so a token matters only where its documents lie in two or more components,
    and a document only where it has enough such tokens. Of its tokens, rarest first, all but the last l - 1 send it to
    cells: similar documents have one of these in common. The cell of a token is named by the first document of its
    list, so documents that share many tokens still meet in few cells. The largest component of a cell is indexed but
    does not ask, so a component with a third of all documents is not searched for itself. Cells over 2,048 documents or
    half a million shingles are dealt into parts that every asking document visits.
    """
    sizes = labels.groupBy("comp").agg(F.count("*").alias("size"))
    known = classes.select("cls", "n").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "comp", F.coalesce("comp", "cls")).join(sizes, "comp", "left").withColumn("size", F.coalesce("size", F.lit(1)))
    held = posted.select("token", "cls").join(known, "cls")
    per_token = held.groupBy("token").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("cls").alias("lead"), F.count("*").alias("df")).where(
        "low <> high").select("token", "lead", "df")
    lowest = lowest_shared_column(F.col("n"), percent)
    docs = (
        held.join(per_token, "token").groupBy("cls").agg(
            F.first("n").alias("n"), F.first("comp").alias("comp"), F.first("size").alias("size"), F.array_sort(
                F.array_distinct(F.collect_list(F.struct("df", "token", "lead")))).alias("held"))
        .where(F.size("held") >= lowest)
    )
    sent = F.array_distinct(F.transform(F.slice("held", F.lit(1), F.size("held") - lowest.cast("int") + 1), lambda h: h["lead"]))
    routed = scratch.stored(docs.select("cls", "n", "comp", "size", F.explode(sent).alias("lead")), "routed")
    cells = routed.groupBy("lead").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.max(F.struct("size", "comp")).alias("big"),
        parts_of(F.count("*"), F.sum("n")).alias("parts")).where("low <> high").select(
        "lead", F.col("big.comp").alias("big"), "parts")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    visits = F.concat(F.array(F.struct(own_part(F.col("parts")).alias("part"), F.lit(0).alias("turn"))), F.when(
        F.col("comp") != F.col("big"), F.transform(every, lambda p: F.struct(p.alias("part"), F.lit(1).alias("turn")))
    ).otherwise(F.array().cast("array<struct<part:int,turn:int>>")))
    meeting = scratch.stored(routed.join(cells, "lead").select("lead", "cls", "comp", F.explode(visits).alias("v")).select(
        "lead", "v.part", "v.turn", "cls", "comp"), "meeting")
    return met_in_cells(meeting, sets_of(meeting.select("cls").distinct()), percent)


def label_sets(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH,
               percent: int = PERCENT) -> DataFrame:
    """(id, text_hash, n, comp) of every row: its set size and the component of its set (null without words).

    1. Equal sets are one class. Each class posts its smallest shingle hashes (see ``set_rows``); postings of tokens that
       no other class has are dropped, and classes left with too few for any partner are out. Only the texts of the others
       are shingled once more, for their whole sets.
    2. The first class of a token's list asks, by T-occurrence search (``divide_skip``), in the lists of the classes with
       which it leads enough tokens. These links, at most a few per class, already join large groups of near copies.
    3. Links across the components of step 2 are found by the same search in ``across``. Both search whole sets, so what
       they find is similar; the components of both are the result.

    Every pair of similar sets is linked, or its ends are in one component already. No list, cell or pair is capped.
    Tables on the way are removed as soon as the next ones stand.
    """
    scratch = Scratch(df.sparkSession)
    source = df.select(quoted(key).alias("id"), quoted(text).alias("text"))
    first = scratch.stored(set_rows(source, "text", "id", width, percent), "sets")
    rows = scratch.stored(first.drop("posted"), "rows")
    shared = scratch.stored(shared_only(postings(first.where("posted is not null").select("cls", "posted"))), "shared")
    scratch.remove("sets")
    lowest = lowest_shared_column(F.col("n"), percent)
    classes = rows.where("n > 0").groupBy("cls").agg(F.first("n").alias("n"), F.min("text_hash").alias("text_hash"))
    alive = scratch.stored(shared.groupBy("cls").agg(F.count("*").alias("c")).join(classes, "cls").where(
        F.col("c") >= lowest).select("cls", "n", "text_hash"), "alive")
    near = shared.join(broadcast_if_small(alive.select("cls", "n"), BROADCAST_ROWS), "cls")
    leads = near.groupBy("token").agg(F.min("cls").alias("lead"), F.max("cls").alias("end")).where("lead <> end").drop("end")
    posted = scratch.stored(near.join(leads, "token").select("token", "cls", "n", "lead"), "posted")
    scratch.remove("shared")
    star = posted.where("cls <> lead").groupBy("cls", "lead", "n").agg(F.count("*").alias("met")).where(
        F.col("met") * 2 >= lowest).select("lead", "cls", "n")
    held = scratch.stored(whole_sets(source, "text", width, alive.select("text_hash")), "whole")
    sets_of = lambda wanted: held.join(broadcast_if_small(wanted, BROADCAST_ROWS), "cls", "left_semi")
    first_links = scratch.stored(led(scratch.stored(star, "star"), sets_of, percent), "links")
    labels = connected(first_links)
    more = scratch.stored(across(posted, alive, labels, percent, sets_of, scratch), "across")
    if not more.isEmpty():
        labels = connected(first_links.unionByName(more))
    marked = rows.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    labelled = stored(marked.select(
        "id", "text_hash", "n", F.when(F.col("n") > 0, F.coalesce("comp", "cls")).alias("comp")), "labelled")
    scratch.remove()
    return labelled


def join_components(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH,
                    percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row: the smallest key that its document reaches over links.

    Documents link when 100 * intersection >= percent * union of their distinct shingles. Null, empty and blank texts
    have no shingles, link with nothing and are their own component, also when repeated. Rows with a null key take part;
    a component's id is its smallest key that is not null. An empty table gives no rows.
    """
    rows = label_sets(df, text, key, width, percent)
    least = rows.where("comp is not null").groupBy("comp").agg(F.min("id").alias("least"))
    return rows.join(least, "comp", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH,
                percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` with one document of each component, that of the smallest key; texts without words all stay.

    Rows to drop are named by key and text hash, so that the texts stay where they are; of rows that repeat the one to be
    kept, one is kept.
    """
    rows = label_sets(df, text, key, width, percent)
    name = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")
    keepers = rows.where("comp is not null").groupBy("comp").agg(F.min(name).alias("keep"))
    judged = rows.join(keepers, "comp").select("id", "text_hash", "comp", name.eqNullSafe(F.col("keep")).alias("kept"))
    counted = judged.groupBy("id", "text_hash").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    mark, given, kept, n, number = fresh(df.columns, "mark", "given", "kept", "n", "number")
    named = df.withColumn(mark, F.xxhash64(quoted(text)))
    verdicts = stored(counted.where("not kept or n > 1").select(
        F.col("id").alias(given), F.col("text_hash").alias(mark), F.col("kept").alias(kept), F.col("n").alias(n)), "verdicts")
    same = quoted(key).eqNullSafe(quoted(given)) & (named[mark] == verdicts[mark])
    lone = named.join(broadcast_if_small(verdicts, BROADCAST_ROWS), same, "left_anti").drop(mark)
    repeated = named.join(broadcast_if_small(verdicts.where(quoted(kept)), BROADCAST_ROWS), same, "left_semi").dropDuplicates([key, mark]).drop(mark)
    return lone.unionByName(repeated)
