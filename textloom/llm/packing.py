"""Problem 7: filling containers of fixed capacity with texts.

Method: conflict-constrained best fit. Documents are spread by a hash over packing
groups of about ``GROUP_ROWS`` documents; a group is packed by one task. Items are
taken in falling size. Open containers are ordered by the room left, and each
carries bitmaps of the sources and of the duplicate clusters it holds (a cluster has
a bit in its group if it has several members there); from the tightest container that has room the search goes on to the next until one is
compatible, else a container is opened. Incompatible are two copies of one text
(the same letters and digits), and sources named as having to stay ``apart``.

Only a text larger than a container is cut: it fills containers of its own, and
what is left over is an item like any other.

Sizes are tokens of a public tokenizer (byte-level BPE ranks, read from a path
that is a parameter). A text is counted piece by piece, as its split pattern never
joins across a single blank or a line break; pieces that come again are looked up.

Defined results: null and empty texts have 0 tokens and go into the group's
first container; every row comes out exactly once, repeated rows and null ids too.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import hash128, letters_digits

CAPACITY = 2048
GROUP_ROWS = 20_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the published split pattern of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN_PIECES = 200_000
OTHER_SPACE = re.compile(r"[^\S \n]")
PACKED = "doc_id bigint, tokens bigint, container bigint, own_containers int, first_own bigint"


class Counter:
    """Counts tokens; the vocabulary is read once a worker."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        lines = text.split("\n")
        if OTHER_SPACE.search(text) or "  " in text or any(not x or x[0] == " " or x[-1] == " " for x in lines):
            # Longer white space is split by what follows it: such lines are joined and counted as they are.
            return self.apart(text)
        return sum(map(self.line, lines)) + (len(lines) - 1) * self.piece("\n")

    def apart(self, text: str) -> int:
        """Cuts only where a single blank or line break stands between two visible characters."""
        total = 0
        for part in re.split(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)", text):
            total += self.piece(part)
        return total

    def line(self, line: str) -> int:
        first, *rest = line.split(" ")
        known, total = self.known, self.piece(first)
        for w in rest:
            n = known.get(" " + w)
            total += n if n is not None else self.piece(" " + w)
        return total

    def piece(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= KNOWN_PIECES:
                self.known.clear()
            n = self.whole(piece)
            if len(piece) <= 64:
                self.known[piece] = n
        return n


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens, source, cluster) of every row; cluster is null for texts without letters and digits."""
    letters = letters_digits(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), F.when(F.length(letters) > 0, F.concat_ws("/", *hash128(letters))).alias("cluster"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for b in batches:
            n = pa.array(map(counter.count, b.column("text").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n, b.column("source"), b.column("cluster")], names=["doc_id", "tokens", "source", "cluster"])

    return rows.mapInArrow(count, "doc_id bigint, tokens bigint, source string, cluster string")


class Bins:
    """Open containers by the room left, with a bit for every room that some container has."""

    def __init__(self, capacity: int) -> None:
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.some = 0
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def open(self, room: int) -> int:
        self.sources.append(0)
        self.clusters.append(0)
        self.put(len(self.sources) - 1, room)
        return len(self.sources) - 1

    def put(self, b: int, room: int) -> None:
        self.at[room].append(b)
        self.some |= 1 << room

    def take(self, room: int, place: int) -> int:
        held = self.at[room]
        held[place], held[-1] = held[-1], held[place]
        b = held.pop()
        if not held:
            self.some &= ~(1 << room)
        return b

    def successor(self, room: int) -> int:
        """The least room not below ``room`` that some container has; -1 if none."""
        rest = self.some >> room
        return room + (rest & -rest).bit_length() - 1 if rest else -1


def pack(items: list[tuple[int, int, int | None, int]], capacity: int, conflicts: dict[int, int] | None = None) -> list[int]:
    """The container of every (size, source, cluster, tie) in order of ``items``; 1 <= size <= capacity.

    A cluster is the number of its bit, null where an item has no copy. ``conflicts`` gives for a source number the bitmap of the sources it must not meet.
    """
    bins, out, conflicts = Bins(capacity), [0] * len(items), conflicts or {}
    order = sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][2] is None, items[i][2] or 0, items[i][3]))
    last: tuple | None = None
    room = place = 0
    for i in order:
        size, source, cluster, _ = items[i]
        bad = conflicts.get(source, 0)
        # Copies come one after the other. What turned the last one away turns this one away too,
        # and containers filled since have the text: the search goes on where it stopped.
        if cluster is None or last != (size, cluster, bad):
            room, place = bins.successor(size), 0
        last = (size, cluster, bad)
        chosen = -1
        while room >= 0:
            held = bins.at[room]
            while place < len(held):
                b = held[place]
                if not (bins.sources[b] & bad) and (cluster is None or not bins.clusters[b] >> cluster & 1):
                    chosen = bins.take(room, place)
                    break
                place += 1
            if chosen >= 0:
                bins.put(chosen, room - size)
                if not bins.at[room]:
                    room, place = bins.successor(room + 1) if room < capacity else -1, 0
                break
            room, place = (bins.successor(room + 1) if room < capacity else -1), 0
        if chosen < 0:
            chosen = bins.open(capacity - size)
        bins.sources[chosen] |= 1 << source
        if cluster is not None:
            bins.clusters[chosen] |= 1 << cluster
        out[i] = chosen
    return out


def containers(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY,
    tokenizer: str = TOKENIZER, apart: tuple[tuple[str, str], ...] = (), group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(doc_id, tokens, container, own_containers, first_own), one row for every row of ``docs``.

    ``container`` holds the text or, of one that was cut, its rest; the parts before
    fill the containers first_own, first_own + 1, ... (null where nothing was cut).
    A rest of nothing is in the last of them.
    """
    groups = max(1, -(-docs.count() // group_rows))
    counted = token_counts(docs, id_col, text_col, source_col, tokenizer)
    counted = counted.withColumn("g", F.pmod(F.xxhash64("doc_id", "cluster", F.monotonically_increasing_id()), F.lit(groups)))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        base = int(key[0]) << 32
        rows = rows.sort_values(["doc_id", "tokens"], kind="stable").reset_index(drop=True)
        names = {s: k for k, s in enumerate(sorted({s for s in rows["source"] if s is not None} | {s for p in apart for s in p}))}
        conflicts: dict[int, int] = {}
        for a, b in apart:
            conflicts[names[a]] = conflicts.get(names[a], 0) | 1 << names[b]
            conflicts[names[b]] = conflicts.get(names[b], 0) | 1 << names[a]
        none = len(names)
        several = rows["cluster"].value_counts()
        bit = {c: k for k, c in enumerate(sorted(several.index[several > 1]))}
        items, index = [], []
        for k, (n, s, c) in enumerate(zip(rows["tokens"], rows["source"], rows["cluster"])):
            if n % capacity:
                items.append((int(n % capacity), names.get(s, none), bit.get(c), k))
                index.append(k)
        got = pack(items, capacity, conflicts)
        container = pd.Series([base] * len(rows), dtype="int64")
        container.iloc[index] = [base + b for b in got]
        following = base + max(got, default=-1) + 1
        first, own = [], []
        for k, n in enumerate(rows["tokens"]):
            whole = int(n) // capacity
            own.append(whole)
            first.append(following if whole else None)
            following += whole
            if whole and n % capacity == 0:
                container.iloc[k] = following - 1
        return pd.DataFrame({"doc_id": rows["doc_id"], "tokens": rows["tokens"], "container": container, "own_containers": pd.Series(own, dtype="int32"), "first_own": pd.array(first, dtype="Int64")})

    return counted.groupBy("g").applyInPandas(one, PACKED)


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(documents, cut, tokens, containers, fill): how well the containers are filled."""
    rest = packed.groupBy("container").agg(F.sum(F.col("tokens") % capacity).alias("t"))
    n = rest.agg(F.sum(F.when(F.col("t") > 0, 1).otherwise(0)).alias("shared"))
    whole = packed.agg(F.count(F.lit(1)).alias("documents"), F.sum((F.col("tokens") > capacity).cast("int")).alias("cut"), F.sum("tokens").alias("tokens"), F.sum("own_containers").alias("own"))
    both = whole.crossJoin(n).withColumn("containers", F.col("own") + F.col("shared"))  # one row each
    return both.select("documents", "cut", "tokens", "containers", F.round(F.col("tokens") / (F.col("containers") * capacity), 6).alias("fill"))


def checks(packed: DataFrame, docs: DataFrame, capacity: int = CAPACITY, apart: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """(documents, missing, twice, overfull, own_shared, copies_together, apart_together): what a packing must keep, counted on its result."""
    letters = letters_digits(F.col("text"))
    about = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", F.when(F.length(letters) > 0, F.concat_ws("/", *hash128(letters))).alias("cluster"))
    x = packed.join(about, "doc_id", "left").withColumn("rest", F.col("tokens") % capacity)
    rest = x.where("rest > 0")
    n = lambda c: F.count(F.when(c, 1))
    ids = about.select("doc_id").distinct().join(packed.select("doc_id").distinct().withColumn("there", F.lit(True)), "doc_id", "left").agg(n(F.col("there").isNull()).alias("missing"))
    twice = packed.groupBy("doc_id").count().agg(n(F.col("count") > 1).alias("twice"))
    over = rest.groupBy("container").agg(F.sum("rest").alias("t"), *(n((F.col("source") == a)).alias(f"a{k}") for k, (a, _) in enumerate(apart)), *(n((F.col("source") == b)).alias(f"b{k}") for k, (_, b) in enumerate(apart)))
    broken = F.lit(False)
    for k in range(len(apart)):
        broken = broken | ((F.col(f"a{k}") > 0) & (F.col(f"b{k}") > 0))
    over = over.agg(n(F.col("t") > capacity).alias("overfull"), n(broken).alias("apart_together"))
    own = x.where("own_containers > 0").select(F.explode(F.sequence("first_own", F.col("first_own") + F.col("own_containers") - 1)).alias("container"))
    own = own.unionByName(rest.select("container").distinct()).groupBy("container").count().agg(n(F.col("count") > 1).alias("own_shared"))
    copies = rest.where("cluster is not null").groupBy("container", "cluster").count().agg(n(F.col("count") > 1).alias("copies_together"))
    out = packed.agg(F.count(F.lit(1)).alias("documents"))
    for part in (ids, twice, over, own, copies):
        out = out.crossJoin(part)  # one row each
    return out.select("documents", "missing", "twice", "overfull", "own_shared", "copies_together", "apart_together")
