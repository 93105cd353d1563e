"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of letters, digits and underscores in lower case; in scripts that are
written without spaces each letter is a word. Every n-gram of
``N`` words of the test items is counted in the documents of the whole corpus. Those in no
more than ``RARE`` of the documents are rare, by a bound that is the same for all items. A place of
a rare n-gram is a seed of its items; a place of a common one is a seed where the words around it
could reach the least score: where they hold enough of the item's words, in any order. No
alignment that holds an n-gram is lost by that. Around its seeds, as far as an alignment of the
least score can reach, the words are aligned
locally with the item's words (match 2, mismatch and gap -1); the score is the
alignment's score over that of the item with itself, so that a copy has 1, and a
copy with every fifth word replaced about 0.7. Copies that keep no ``N`` words in a row have
no seed (every third word replaced: 0.5).

The test items are the bounded side. They are taken in blocks of ``BLOCK_BYTES``
of text, each collected and broadcast; each block is searched in all documents, in
Arrow batches where the documents lie. Documents are never shuffled. ``contaminated`` splits them into words
once for each block: word numbers around the places of known n-grams are staged, and counts and alignments are taken
from there. ``clean``, which has to return whole rows, reads them twice.

Defined cases: the one seed of an item with fewer than ``N`` words is its whole word
sequence, and items without words match nothing; null
texts, null item ids and empty tables give no rows; repeated documents give their rows
again; equal items (also of one id) are one item of each id. Of equal scores in a document the
first place is returned.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from salesprep.llm.shared import longs, slices, stage
from salesprep.staging import observed, scope

N = 3
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST_SCORE = 0.5
#: Share of the documents up to which an n-gram is rare; in one document it always is.
RARE = 0.001
BLOCK_BYTES = 16 << 20
#: Thai, Lao, Tibetan, Myanmar, Khmer, kana, bopomofo, Han and their extensions.
UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U000323af"
WORD = re.compile(rf"[^\W{UNSPACED}]+|\w")
#: The same in texts whose characters all come before those scripts.
SPACED_WORD = re.compile(r"\w+")
UNKNOWN = -1
#: Numbers of n-grams keep this many bits.
GRAM_BITS = (1 << 63) - 1


@dataclass
class Block:
    """Test items as word numbers, the different words of each with their counts, and their n-grams as numbers."""

    words: dict[str, int]
    size: int
    items: list[tuple[int, np.ndarray]]
    bags: list[tuple[np.ndarray, np.ndarray]]
    grams: np.ndarray
    owners: list[list[int]]
    widths: list[int]


def words_of(text: str) -> list[str]:
    low = text.lower()
    # the units of characters beyond 16 bits lie above those scripts' first letter as well
    units = () if low.isascii() else np.frombuffer(low.encode("utf-16-le", "surrogatepass"), "<u2")
    return (WORD if len(units) and units.max() >= ord(UNSPACED[0]) else SPACED_WORD).findall(low)


def numbered(words: list[str], known: dict[str, int]) -> np.ndarray:
    return np.fromiter(map(known.get, words, repeat(UNKNOWN)), np.int64, len(words))


def gram_numbers(ids: np.ndarray, size: int, width: int = N) -> np.ndarray:
    """A number for each gram of ``width`` (1 to ``N``) words of a sequence; ``UNKNOWN`` where a word is unknown.

    Beyond a million words the numbers wrap around and two grams may share one. They are then counted together and are
    seeds of the items of both, which loses none: a seed only says where to align.
    """
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    known = np.ones(n, bool)
    for k in range(width):
        known &= ids[k : k + n] >= 0
    places = np.flatnonzero(known)
    numbers = np.zeros(len(places), np.int64)
    for k in range(width):
        numbers = numbers * size + ids[places + k]
    found = np.full(n, UNKNOWN, np.int64)
    found[places] = (numbers * N + N - width) & GRAM_BITS
    return found


def make_block(rows: list[tuple[int, str]]) -> Block:
    words: dict[str, int] = {}
    for _, text in rows:
        for w in words_of(text):
            words.setdefault(w, len(words))
    items = [(item, numbered(words_of(text), words)) for item, text in rows]
    # odd, so that no word's number is lost where the grams' numbers wrap around
    size = len(words) | 1
    owners = defaultdict(list)
    for i, (_, ids) in enumerate(items):
        for gram in set(gram_numbers(ids, size, min(N, len(ids))).tolist()) if len(ids) else ():
            owners[gram].append(i)
    grams = np.array(sorted(owners), np.int64)
    widths = sorted({min(N, len(ids)) for _, ids in items if len(ids)})
    bags = [np.unique(ids, return_counts=True) for _, ids in items]
    return Block(words, size, items, bags, grams, [owners[g] for g in grams.tolist()], widths)


def hits(block: Block, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of a text, the places of its known grams (in order for each width), and which they are."""
    ids = numbered(words_of(text), block.words)
    found = [gram_numbers(ids, block.size, width) for width in block.widths]
    places = [np.flatnonzero(numbers >= 0) for numbers in found]
    numbers = np.concatenate([np.zeros(0, np.int64), *(x[p] for x, p in zip(found, places, strict=True))])
    places = np.concatenate([np.zeros(0, np.int64), *places])
    at = np.searchsorted(block.grams, numbers)
    fits = at < len(block.grams)
    fits[fits] = block.grams[at[fits]] == numbers[fits]
    return ids, places[fits], at[fits]


def align(item: np.ndarray, part: np.ndarray, anchored: bool = False) -> tuple[int, int, int]:
    """Smith-Waterman score of two word sequences, and how much of ``item`` and ``part`` lies before the end of the best alignment.

    An ``anchored`` alignment begins at the first words of both.
    """
    steps = np.arange(len(part) + 1) * GAP
    above, best, rows, end = steps * anchored, 0, 0, 0
    for k, word in enumerate(item, 1):
        row = np.full(len(part) + 1, k * GAP * anchored, np.int64)
        row[1:] = np.maximum(above[:-1] + np.where(part == word, MATCH, MISMATCH), above[1:] + GAP)
        if not anchored:
            row = np.maximum(row, 0)
        above = np.maximum.accumulate(row - steps) + steps
        if (top := int(above.max())) > best:
            best, rows, end = top, k, int(above.argmax())
    return best, rows, end


def begin(item: np.ndarray, part: np.ndarray, rows: int, end: int) -> int:
    """Where in ``part`` an alignment begins that ends before word ``rows`` of the item and ``end`` of the part."""
    return end - align(item[:rows][::-1], part[:end][::-1], anchored=True)[2]


def most_score(bag: tuple[np.ndarray, np.ndarray], part: np.ndarray) -> float:
    """Bound of an item's score: that of all words the two have in common, in order and without gaps."""
    words, counts = bag
    at = np.searchsorted(words, part)
    at[at == len(words)] = 0
    common = np.bincount(at[words[at] == part], minlength=len(words))
    return int(np.minimum(common, counts).sum()) / int(counts.sum())


def reach_of(item: np.ndarray, least_score: float) -> int:
    """Words beside a gram that an alignment of the least score can reach.

    Matches give 2 at most for a word of the item, so this many words can be put in between.
    """
    return len(item) + max(0, int(2 * len(item) * (1 - least_score)))


def candidates(block: Block, rare: np.ndarray, text: str, least_score: float) -> Iterator[tuple[int, float, int, int]]:
    """``aligned`` of a text."""
    return aligned(block, rare, *hits(block, text), least_score)


def aligned(block: Block, rare: np.ndarray, ids: np.ndarray, places: np.ndarray, grams: np.ndarray, least_score: float) -> Iterator[tuple[int, float, int, int]]:
    """Item, score, first word of the aligned passage and the one after it, of each item that reaches the least score, from a text's ``hits``."""
    by_item = defaultdict(list)
    for place, gram in zip(places.tolist(), grams.tolist(), strict=True):
        for i in block.owners[gram]:
            by_item[i].append((place, rare[gram]))
    for i, held in by_item.items():
        item = block.items[i][1]
        reach = reach_of(item, least_score)
        around = lambda p: ids[max(0, p - reach) : p + N + reach]  # noqa: E731, B023
        found = [p for p, seldom in held if seldom or most_score(block.bags[i], around(p)) >= least_score]
        if not found:
            continue
        best = (0.0, 0, 0, 0, 0)
        span = None
        for place in [*found, None]:
            if span and (place is None or place - reach > span[1]):
                score, rows, end = align(item, ids[span[0] : span[1]])
                score /= MATCH * len(item)
                if score > best[0]:
                    best = (score, rows, end, *span)
                span = None
            if place is not None:
                span = (span[0] if span else max(0, place - reach), place + N + reach)
        score, rows, end, first, last = best
        if score >= least_score:
            yield i, score, first + begin(item, ids[first:last], rows, end), first + end


def rare_grams(block: Broadcast, counts: DataFrame, documents: int) -> np.ndarray:
    """Which n-grams of a block are rare, of ``counts`` (gram, n); one row for each n-gram of the block at most comes back."""
    found = np.zeros(len(block.value.grams), np.int64)
    for gram, n in counts.toLocalIterator():
        found[gram] = n
    return found <= max(1, RARE * documents)


def count_grams(texts: DataFrame, block: Broadcast) -> np.ndarray:
    """Which n-grams of a block are rare, counted over all ``texts`` (column t)."""
    seen = Observation()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(block.value.grams), np.int64)
        for batch in slices(batches):
            for text in batch["t"].to_pylist():
                totals[np.unique(hits(block.value, text)[2])] += 1
        held = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([longs(held), longs(totals[held])], names=["gram", "n"])

    read = texts.observe(seen, F.count(F.lit(1)).alias("n"))
    counts = stage(read.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")), "decontamination-counts")
    return rare_grams(block, counts, observed(seen).get("n", 0))


def ints(values: list[np.ndarray]) -> pa.Array:
    """Arrays as one list column."""
    ends = np.cumsum([0, *map(len, values)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *values]).astype(np.int32, copy=False)))


def arrays(column: pa.Array) -> list[np.ndarray]:
    """The reverse of ``ints``."""
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends)[:-1]


def stage_hits(texts: DataFrame, block: Broadcast, least_score: float) -> tuple[DataFrame, np.ndarray]:
    """The ``hits`` of every text that has some, staged, and which n-grams are rare.

    Words that no alignment of the least score can reach are ``UNKNOWN`` there; runs of them take next to no space.
    """
    seen = Observation()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = block.value
        reaches = np.array([max(reach_of(known.items[i][1], least_score) for i in own) for own in known.owners], np.int64)
        for batch in slices(batches):
            owners, found = [], []
            for at, text in enumerate(batch["t"].to_pylist()):
                ids, places, grams = hits(known, text)
                if not len(places):
                    continue
                edges = np.zeros(len(ids) + 1, np.int64)
                np.add.at(edges, np.maximum(places - reaches[grams], 0), 1)
                np.add.at(edges, np.minimum(places + N + reaches[grams], len(ids)), -1)
                owners.append(at)
                found.append((np.where(np.cumsum(edges[:-1]) > 0, ids, UNKNOWN).astype(np.int32), places, grams))
            columns = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(owners, pa.int64())), *map(ints, columns)], names=["doc_id", "words", "places", "grams"])

    read = texts.observe(seen, F.count(F.lit(1)).alias("n"))
    found = stage(read.mapInArrow(find, "doc_id long, words array<int>, places array<int>, grams array<int>"), "decontamination-hits")
    counts = found.select(F.explode(F.array_distinct("grams")).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return found, rare_grams(block, counts, observed(seen).get("n", 0))


def blocks_of(benchmark: DataFrame, item_id: str, item_text: str) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``BLOCK_BYTES`` of text."""
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).orderBy("i", "t").collect()
        yield [(r.i, r.t) for r in rows]


def contaminated(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (doc_id, item_id, score, first_word, last_word) of documents that hold an item, at ``least_score`` or more.

    The aligned passage goes from ``first_word`` to before ``last_word``.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).where("t IS NOT NULL")
    found = None
    for rows in blocks_of(benchmark, item_id, item_text):
        shared = spark.sparkContext.broadcast(make_block(rows))
        # only the result outlives its block
        with scope(spark) as own:
            held, seldom = stage_hits(texts, shared, least_score)
            rare = spark.sparkContext.broadcast(seldom)

            def search(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared, rare: Broadcast = rare) -> Iterator[pa.RecordBatch]:
                block, seldom = shared.value, rare.value
                for batch in slices(batches):
                    out = []
                    columns = (arrays(batch[name]) for name in ("words", "places", "grams"))
                    for doc, *parts in zip(batch["doc_id"].to_pylist(), *columns, strict=True):
                        out += [(doc, block.items[i][0], s, a, b) for i, s, a, b in aligned(block, seldom, *parts, least_score)]
                    columns = list(zip(*out, strict=True)) or [()] * 5
                    types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "item_id", "score", "first_word", "last_word"])

            part = stage(held.mapInArrow(search, "doc_id long, item_id long, score double, first_word long, last_word long"), "decontamination-found")
            own.keep(part)
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, benchmark: DataFrame, least_score: float = LEAST_SCORE, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a test item, at ``least_score`` or more."""
    names = docs.columns
    place = names.index(text)
    kept = docs.toDF(*[f"c{i}" for i in range(len(names))])
    texts = kept.select(F.col(f"c{place}").alias("t")).where("t IS NOT NULL")
    for rows in blocks_of(benchmark, item_id, item_text):
        shared = texts.sparkSession.sparkContext.broadcast(make_block(rows))
        with scope(texts.sparkSession):
            rare = texts.sparkSession.sparkContext.broadcast(count_grams(texts, shared))

        def drop(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared, rare: Broadcast = rare) -> Iterator[pa.RecordBatch]:
            block, seldom = shared.value, rare.value
            for batch in slices(batches):
                keep = [not any(True for _ in candidates(block, seldom, t or "", least_score)) for t in batch[place].to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

        kept = kept.mapInArrow(drop, kept.schema)
    return kept.toDF(*names)
