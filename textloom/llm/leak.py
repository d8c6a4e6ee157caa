"""Problem 8: evaluation texts leaking into training text.

Method: a distributed positional inverted index. The documents are read once and
indexed in segments of about ``SEGMENT_WORDS`` words: for every term of a segment
the sorted list of its positions, for all terms, whether an item has them or not.
The index is written as a table (``build_index``) and only that is read in a
search; the number of items doesn't change how often the documents are read.

A search first asks the index how often each term of the items stands in the
whole corpus. Of every few neighbouring words of an item the rarest two are taken
(two, since any single word may have been changed), and their postings are
brought to a common origin by subtracting the item's offset. The lists of the
item's other terms are intersected with them in the same way, up to the words that
single additions shift: first close around the anchor, then over a whole passage.
What is left is compared word by word, from the postings of the item's terms. Nothing depends on which documents share a
segment.

A passage counts with at least ``min_words`` item words in a row. Letter case,
diacritics, punctuation and spacing are ignored, single changed or added words
are bridged, and so is one break of at most ``break_words`` words. ``kind`` says
whether ``min_words`` words stand in a row as they are (exact) or not (proximity).

The items are a query set: they are taken in blocks of at most ``block`` items,
so what is sent to the executors is bounded whatever the number of items.

Defined results: null and blank texts and items with fewer than ``min_words``
words match nothing; repeated rows give each pair once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import once
from textloom.llm.terms import lists, plain_words, term_numbers
from textloom.session import cut

MIN_WORDS = 12
#: Of so many neighbouring words of an item the ANCHORS rarest are looked up.
ANCHOR_WINDOW = 4
ANCHORS = 2
#: How far added words may shift the origin of a passage.
SHIFT = 3
BREAK_WORDS = 30
#: The least part of a broken passage has so many words, and they lie within REACH words of each other, as single ones may differ.
LEAST_PART = 4
REACH = 2 * (LEAST_PART - 1)
#: The least share of the words of a passage of min_words that must stand near an item's origins to look closer; a passage has 0.7.
LEAST_DENSE = 0.6
BLOCK = 2000
#: A segment ends with the document that reaches so many words. A row of the index is a segment.
SEGMENT_WORDS = 300_000
SEGMENTS_PER_FILE = 16
INDEX = "ids array<bigint>, base array<int>, terms array<int>, start array<int>, steps array<int>"
SCHEMA = "item_id bigint, doc_id bigint, words int, kind string"


def segment_row(ids: np.ndarray, words: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """A row of the index. Positions are kept as steps from one to the next, which are small numbers."""
    # One free position after every document keeps passages apart.
    base = np.concatenate([[0], np.cumsum(length + 1)])
    at = np.arange(len(words)) + np.repeat(np.arange(len(length)), length)
    order = np.argsort(words, kind="stable")
    terms, start = np.unique(words[order], return_index=True)
    return [ids, base, terms, np.append(start, len(words)), np.diff(at[order], prepend=0)]


def build_index(docs: DataFrame, doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """The positional index of all words of all documents, as a table in the shared folder."""
    corpus = docs.select(F.col(doc_id).cast("bigint").alias("d"), F.col(doc_text).alias("t")).where("d is not null and t is not null")
    corpus = corpus.select("d", term_numbers(plain_words(F.col("t"))).alias("w"))
    types = [pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def row() -> pa.RecordBatch:
            cols = segment_row(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, types)], names=[x.split()[0] for x in INDEX.split(", ")])

        for b in batches:
            ids, (words, start) = b.column(0).to_numpy(), lists(b.column(1))
            lo = 0
            while lo < len(ids):
                room = SEGMENT_WORDS - sum(len(w) for _, w, _ in held)
                hi = min(len(ids), max(lo + 1, int(np.searchsorted(start, start[lo] + room))))
                held.append((ids[lo:hi], words[start[lo] : start[hi]], np.diff(start[lo : hi + 1])))
                if sum(len(w) for _, w, _ in held) >= SEGMENT_WORDS:
                    yield row()
                lo = hi
        if held:
            yield row()

    return cut(corpus.mapInArrow(of, INDEX), "positional-index", SEGMENTS_PER_FILE)


class Items:
    """The test items of one block as arrays of places in ``terms``, the sorted term numbers of all items."""

    def __init__(self, rows: list[tuple[int, list[int]]], min_words: int = MIN_WORDS) -> None:
        self.min_words = min_words
        kept = [(i, w) for i, w in rows if len(w) >= min_words]
        self.ids = np.array([i for i, _ in kept], np.int64)
        length = np.array([len(w) for _, w in kept], np.int64)
        words = np.concatenate([np.array(w, np.int32) for _, w in kept]) if kept else np.zeros(0, np.int32)
        self.terms, self.flat = np.unique(words, return_inverse=True)
        self.flat = self.flat.astype(np.int64)
        self.item = np.repeat(np.arange(len(kept)), length)
        self.first = np.concatenate([[0], np.cumsum(length)])
        self.tokens = [self.flat[a:b] for a, b in zip(self.first, self.first[1:])]
        self.anchor = np.zeros(0, np.int64)

    def choose(self, held: np.ndarray) -> None:
        """Sets the words to look up, given how often the corpus holds every term."""
        n = len(self.flat)
        if not n:
            return
        most = np.iinfo(np.int64).max
        # A word that the corpus doesn't hold leaves the window to the others.
        weight = np.where(held[self.flat] > 0, held[self.flat].astype(np.int64) * (n + 1) + np.arange(n), most)
        window = np.lib.stride_tricks.sliding_window_view(np.append(weight, np.full(ANCHOR_WINDOW - 1, most)), ANCHOR_WINDOW)
        whole = np.arange(n) + ANCHOR_WINDOW <= self.first[self.item + 1]
        at = np.unique(np.arange(n)[whole][:, None] + window[whole].argsort(1)[:, :ANCHORS])
        self.anchor = at[held[self.flat[at]] > 0]


class Segment:
    """A row of the index, as far as the items have its terms."""

    def __init__(self, ids: np.ndarray, base: np.ndarray, terms: np.ndarray, start: np.ndarray, steps: np.ndarray, items: Items) -> None:
        self.ids, self.base = ids, base.astype(np.int64)
        place = np.searchsorted(terms, items.terms)
        there = place < len(terms)
        there[there] = terms[place[there]] == items.terms[there]
        place = np.where(there, place, 0)
        start = start.astype(np.int64)
        self.held = np.where(there, (start[1:] - start[:-1])[place] if len(terms) else 0, 0)
        self.start = start[place]
        self.at = np.cumsum(steps, dtype=np.int64)
        self.tokens = np.full(int(self.base[-1]) + 1, -1, np.int64)
        which, position = self.postings(np.arange(len(items.terms)))
        self.tokens[position] = which

    def postings(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which term of ``terms``, position) for all postings of all terms."""
        n = self.held[terms]
        which = np.repeat(np.arange(len(terms)), n)
        place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, self.at[self.start[terms][which] + place]


def segments(batch: pa.RecordBatch, items: Items) -> Iterator[Segment]:
    cols = [lists(batch.column(k)) for k in range(5)]
    for r in range(batch.num_rows):
        yield Segment(*(v[s[r] : s[r + 1]] for v, s in cols), items)


def surrounded(items: Items, seg: Segment, at: np.ndarray, item: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether LEAST_PART of the item's words, the anchor at ``at`` among them, stand around the position."""
    words, left = np.ones(len(at), np.int8), np.arange(len(at))
    steps = sorted((*range(-REACH, 0), *range(1, REACH + 1)), key=abs)
    for done, k in enumerate(steps):
        a, i, p = at[left], item[left], position[left]
        there = (a + k >= items.first[i]) & (a + k < items.first[i + 1])
        word = np.where(there, items.flat[np.clip(a + k, 0, len(items.flat) - 1)], -2)
        hit = np.zeros(len(left), bool)
        for shift in range(-SHIFT, SHIFT + 1):
            hit |= seg.tokens[np.clip(p + (k + shift), 0, len(seg.tokens) - 1)] == word
        words[left] += hit
        # Those that have enough, or can't have enough any more, are settled.
        left = left[(words[left] < LEAST_PART) & (words[left] + (len(steps) - done - 1) >= LEAST_PART)]
    return words >= LEAST_PART


def crowded(items: Items, seg: Segment, item: np.ndarray, doc: np.ndarray, origin: np.ndarray) -> np.ndarray:
    """Which rows (in order of item and document) belong to a pair with at least LEAST_DENSE of the words of some passage.

    All item words that stand near one of the pair's origins count. A passage of
    ``min_words`` has more of them than asked for here, broken or not.
    """
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (doc[1:] != doc[:-1])
    pair = np.cumsum(new) - 1
    length = (items.first[1:] - items.first[:-1])[item[new]]
    base = np.concatenate([[0], np.cumsum(length)])
    hits = np.zeros(int(base[-1]), bool)
    use = np.flatnonzero(new | np.append(True, origin[1:] != origin[:-1])[: len(item)])
    step = max(1, 4_000_000 // max(1, int(length.max(initial=1))))
    for lo in range(0, len(use), step):  # bounds what is held at once
        u = use[lo : lo + step]
        n = length[pair[u]]
        row = np.repeat(u, n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        word, place = items.flat[items.first[item[row]] + at], origin[row] + at
        first, last = seg.base[doc[row]], seg.base[doc[row] + 1] - 1
        hit = np.zeros(len(row), bool)
        for shift in range(-SHIFT, SHIFT + 1):
            p = place + shift
            hit |= (p >= first) & (p < last) & (seg.tokens[np.clip(p, 0, len(seg.tokens) - 1)] == word)
        hits[(base[pair[row]] + at)[hit]] = True
    total = np.concatenate([[0], np.cumsum(hits)])
    of = np.repeat(np.arange(len(length)), length)
    start = np.arange(len(hits))
    start = start[start + items.min_words <= base[of + 1]]
    dense = np.zeros(len(length), bool)
    dense[of[start[total[start + items.min_words] - total[start] >= LEAST_DENSE * items.min_words]]] = True
    return dense[pair]


def candidates(items: Items, seg: Segment) -> Iterator[tuple[int, int, np.ndarray]]:
    """(item, document, origins): where two anchors agree, or one has the item's words around it, and enough words are near."""
    item = items.item[items.anchor]
    for lo in range(0, len(items.ids), 64):  # bounds what is held at once
        start, stop = np.searchsorted(item, [lo, lo + 64])
        anchor = items.anchor[start:stop]
        which, position = seg.postings(items.flat[anchor])
        anchor = anchor[which]
        i = items.item[anchor]
        origin = position - (anchor - items.first[i])
        doc = np.searchsorted(seg.base, position, "right") - 1
        order = np.lexsort((position, origin, doc, i))
        i, doc, origin, position, anchor = i[order], doc[order], origin[order], position[order], anchor[order]
        around = surrounded(items, seg, anchor, i, position)
        i, doc, origin = i[around], doc[around], origin[around]
        kept = crowded(items, seg, i, doc, origin)
        i, doc, origin = i[kept], doc[kept], origin[kept]
        cut = np.flatnonzero((i[1:] != i[:-1]) | (doc[1:] != doc[:-1])) + 1
        for part in np.split(np.arange(len(i)), cut):
            if len(part):
                yield int(i[part[0]]), int(doc[part[0]]), np.unique(origin[part])


def stretches(item: np.ndarray, doc: np.ndarray, origin: int) -> list[tuple[int, int, int, int, int, int]]:
    """(first, last, matched, doc first, doc last, unbroken) of runs of item words near one origin; one word may differ at a time."""
    at = np.arange(len(item))
    # Nearest origins first: a word counts once, at the least shift.
    where = np.full(len(item), -1)
    for shift in sorted(range(-SHIFT, SHIFT + 1), key=abs):
        p = at + origin + shift
        ok = (where < 0) & (p >= 0) & (p < len(doc))
        ok[ok] = doc[p[ok]] == item[ok]
        where[ok] = p[ok]
    hit = np.flatnonzero(where >= 0)
    out, run = [], []
    for h in hit:
        if run and (h - run[-1] > 2 or not 0 < where[h] - where[run[-1]] <= 3):
            if where[h] <= where[run[-1]] and h - run[-1] <= 2:
                continue  # a chance match behind the passage
            out.append(run)
            run = []
        run.append(h)
    if run:
        out.append(run)
    return [(r[0], r[-1], len(r), int(where[r[0]]), int(where[r[-1]]), unbroken(np.array(r), where)) for r in out if len(r) >= 3]


def unbroken(run: np.ndarray, where: np.ndarray) -> int:
    """The most words of a run that stand in a row in the item and in the document."""
    gaps = np.flatnonzero((np.diff(run) != 1) | (np.diff(where[run]) != 1))
    return int(np.diff(np.concatenate([[-1], gaps, [len(run) - 1]])).max())


def passage(item: np.ndarray, doc: np.ndarray, origins: np.ndarray, min_words: int, break_words: int = BREAK_WORDS) -> tuple[int, bool]:
    """The item words in a row that the document holds, and whether ``min_words`` of them stand unchanged in a row."""
    runs = {s for o in origins for s in stretches(item, doc, int(o))}
    best, exact = 0, False
    runs = sorted(runs)
    for a in runs:
        words = a[1] - a[0] + 1
        exact |= a[5] >= min_words
        if a[2] >= 0.7 * words:
            best = max(best, words)
        for b in runs:
            # One break: the second part goes on in the item where the first part ended.
            if a[1] < b[0] <= a[1] + 3 and a[4] < b[3] <= a[4] + 1 + break_words and min(a[2], b[2]) >= LEAST_PART:
                words = b[1] - a[0] + 1
                if a[2] + b[2] >= 0.7 * words:
                    best = max(best, words)
    return best, exact


def search(seg: Segment, items: Items, break_words: int = BREAK_WORDS) -> list[tuple[int, int, int, str]]:
    """All matches of the items in one segment."""
    out = []
    for i, d, origins in candidates(items, seg):
        lo, hi = int(seg.base[d]), int(seg.base[d + 1])
        words, exact = passage(items.tokens[i], seg.tokens[lo:hi], origins - lo, items.min_words, break_words)
        if words >= items.min_words:
            out.append((int(items.ids[i]), int(seg.ids[d]), words, "exact" if exact else "proximity"))
    return out


def term_counts(index: DataFrame, items: Items) -> np.ndarray:
    """How often the corpus holds every term of the items; as many numbers as a block of items has terms."""
    sent = index.sparkSession.sparkContext.broadcast(items.terms)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        n = np.zeros(len(asked), np.int64)
        for b in batches:
            (terms, at), (start, first) = lists(b.column(0)), lists(b.column(1))
            for r in range(b.num_rows):
                t, s = terms[at[r] : at[r + 1]], start[first[r] : first[r + 1]]
                place = np.searchsorted(t, asked)
                there = np.flatnonzero(place < len(t))
                there = there[t[place[there]] == asked[there]]
                n[there] += np.diff(s)[place[there]]
        k = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(n[k])], names=["k", "n"])

    held = np.zeros(len(items.terms), np.int64)
    for r in index.select("terms", "start").mapInArrow(of, "k int, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        held[r.k] = r.n
    return held


def matches(
    items: DataFrame, docs: DataFrame, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text",
    min_words: int = MIN_WORDS, block: int = BLOCK, break_words: int = BREAK_WORDS, index: DataFrame | None = None,
) -> DataFrame:
    """(item_id, doc_id, words, kind) of every document that holds a passage of an item.

    ``index`` is an index of the documents that is there already.
    """
    spark = docs.sparkSession
    index = build_index(docs, doc_id, doc_text) if index is None else index
    queries = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("i is not null and t is not null")
    blocks = max(1, -(-queries.count() // block))
    queries = queries.select("i", once(term_numbers(plain_words(F.col("t")))).alias("w"))
    out = None
    for k in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).collect()
        asked = Items([(r.i, r.w) for r in rows], min_words)
        asked.choose(term_counts(index, asked))
        sent = spark.sparkContext.broadcast(asked)

        def of(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for seg in segments(b, sent.value):
                    got = search(seg, sent.value, break_words)
                    cols = list(zip(*got)) if got else [[], [], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.string()))], names=["item_id", "doc_id", "words", "kind"])

        part = index.mapInArrow(of, SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("item_id", "doc_id").agg(F.max("words").alias("words"), F.min("kind").alias("kind"))


def found(items: DataFrame, docs: DataFrame) -> DataFrame:
    return matches(items, docs).select("item_id", "doc_id")
