"""Benchmark decontamination with an FM-index over every training shard.

Texts and items are compared by words (see ``common.words``).  A window is ten
consecutive words of an item (an item of fewer words is one window).  Windows are
searched backwards in an FM-index of each shard of the documents; the occurrences
are located by sampled suffix positions and merged into removal spans.

How it runs: the items are the stated query set, taken in blocks of bounded size,
and one block at a time is sent to the executors.  A block is one pass over the
documents with no shuffle; later blocks add to the spans that earlier ones found.
A shard is a bounded run of rows of one task.  Only runs of words which occur in
some window of the block, and which are long enough to hold its shortest window,
enter the index: no other word can take part in an occurrence.

Defined cases: a null or empty text has no words and no hit; a null or wordless
item has no window; items with equal ids count once; repeated document rows are
reported each; columns beside id and text are kept untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import WORD_BYTES, col, trimmed, whole_row, words

#: Bytes of item text searched for in one pass, and bytes of text of a shard.
BLOCK_BYTES = 32 << 20
SHARD_BYTES = 16 << 20
#: Every position that is a multiple of this keeps its place in the text.
SAMPLE = 8


# -- the index ------------------------------------------------------------------

class WaveletMatrix:
    """Rank and access on a sequence of small integers, for vectors of queries."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.ones: list[np.ndarray] = []  # ones before each place
        self.zeros: list[int] = []
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level) & 1
            before = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=before[1:])
            self.ones.append(before)
            self.zeros.append(len(seq) - int(before[-1]))
            seq = np.concatenate((seq[bit == 0], seq[bit == 1]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low, high = np.zeros_like(place), place
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = (symbol >> (self.levels - 1 - k)) & 1
            low_1, high_1 = ones[low], ones[high]
            low = np.where(bit, zeros + low_1, low - low_1)
            high = np.where(bit, zeros + high_1, high - high_1)
        return high - low

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before."""
        symbol = np.zeros_like(place)
        low = np.zeros_like(place)
        for ones, zeros in zip(self.ones, self.zeros):
            bit = ones[place + 1] - ones[place]
            symbol = symbol * 2 + bit
            place = np.where(bit, zeros + ones[place], place - ones[place])
            low = np.where(bit, zeros + ones[low], low - ones[low])
        return symbol, place - low


def suffix_array(seq: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order, by prefix doubling.  Places where ``ends`` holds carry
    end marks, which differ from each other and sort first, in order of place."""
    n = len(seq)
    rank = seq.astype(np.int64) + n
    rank[ends] = np.arange(int(ends.sum()))
    _, rank = np.unique(rank, return_inverse=True)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        changed = np.empty(n, np.int64)
        changed[0] = 0
        changed[1:] = key[order][1:] != key[order][:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed)
        if changed.sum() == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Backward search over a shard: ``seq`` has symbols 1.. and 0 for end marks."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.order = suffix_array(seq, seq == 0)
        self.sigma = sigma
        before = np.bincount(seq, minlength=sigma + 1)
        self.starts = np.concatenate(([0], np.cumsum(before)))[: sigma + 1]
        bwt = seq[self.order - 1]  # of the first place: the last end mark
        self.wavelet = WaveletMatrix(bwt.astype(np.int32), sigma)
        #: Kept places: multiples of SAMPLE, and the first of each run.
        first = np.concatenate(([True], seq[:-1] == 0))
        keep = (self.order % SAMPLE == 0) | first[self.order]
        self.kept_before = np.concatenate(([0], np.cumsum(keep)))
        self.kept = self.order[keep]
        self.is_kept = keep
        self.n = len(seq)
        del self.order

    def count(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that start with each window (rows; -1 pads at the left)."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self.n, np.int64)
        for k in range(windows.shape[1] - 1, -1, -1):
            live = np.flatnonzero((windows[:, k] > 0) & (low < high))
            symbol = windows[live, k]
            low[live] = self.starts[symbol] + self.wavelet.rank(symbol, low[live])
            high[live] = self.starts[symbol] + self.wavelet.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of suffix rows: walk left to a kept one."""
        place = np.full(len(rows), -1, np.int64)
        at, steps = rows.astype(np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            done = self.is_kept[at[live]]
            found = live[done]
            place[found] = self.kept[self.kept_before[at[found]]] + steps[found]
            live = live[~done]
            symbol, before = self.wavelet.access(at[live])
            at[live] = self.starts[symbol] + before
            steps[live] += 1
        return place


# -- a block of items -----------------------------------------------------------

class Phrases:
    """The windows of a block of items: equal windows once, by their items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            w = words(text)
            for k in range(max(1, len(w) - window + 1) if w else 0):
                owners.setdefault(tuple(w[k:k + window]), set()).add(item)
        self.symbols: dict[bytes, int] = {}
        for phrase in owners:
            for w in phrase:
                self.symbols.setdefault(w, len(self.symbols) + 1)
        self.windows = np.full((len(owners), window), -1, np.int32)
        for row, phrase in zip(self.windows, owners):
            row[window - len(phrase):] = [self.symbols[w] for w in phrase]
        self.lengths = np.array([len(p) for p in owners], np.int64)
        self.owners = list(owners.values())
        self.shortest = int(self.lengths.min()) if owners else 0

    @classmethod
    def of(cls, parts: dict) -> Phrases:
        """Of the attributes of another: a broadcast carries plain data only."""
        own = cls.__new__(cls)
        own.__dict__.update(parts)
        return own


def _runs(symbols: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """Stretches of known words that can hold a window."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], symbols > 0, [0]))))
    start, end = edge[::2], edge[1::2]
    long_enough = end - start >= shortest
    return list(zip(start[long_enough].tolist(), end[long_enough].tolist()))


def _search(shard: list[list[tuple[int, int, np.ndarray]]], phrases: Phrases):
    """Spans and items of each document of a shard.

    ``shard`` has, for each document, its runs: start, end, symbols."""
    hits: list[tuple[list, set]] = [([], set()) for _ in shard]
    runs = [(doc, run) for doc, rs in enumerate(shard) for run in rs]
    if not runs:
        return hits
    seq = np.concatenate([np.append(run[2], 0) for _, run in runs]).astype(np.int32)
    begins = np.cumsum([0] + [len(run[2]) + 1 for _, run in runs])[:-1]
    index = FMIndex(seq, len(phrases.symbols) + 1)
    low, high = index.count(phrases.windows)
    found = np.flatnonzero(high > low)
    if not len(found):
        return hits
    times = (high - low)[found]
    which = np.repeat(found, times)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    place = index.locate(low[which] + offset)
    run_of = np.searchsorted(begins, place, side="right") - 1
    for window, at, r in zip(which.tolist(), place.tolist(), run_of.tolist()):
        doc, (start, _, _) = runs[r]
        begin = start + at - int(begins[r])
        hits[doc][0].append((begin, begin + int(phrases.lengths[window])))
        hits[doc][1].update(phrases.owners[window])
    return hits


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def without_spans(text: str, spans: list) -> str:
    """``text`` less the words of the spans and what stands between them."""
    data = text.encode("utf-8", "surrogatepass")
    flags = np.frombuffer(data.translate(WORD_BYTES), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags, [0]))))
    starts, ends = edge[::2], edge[1::2]
    out, at = [], 0
    for begin, end in spans:
        out.append(data[at:int(starts[begin])])
        at = int(ends[end - 1])
    out.append(data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")


# -- the pass over the documents ------------------------------------------------

def _pass(phrases, cut: bool):
    """Task: adds what one block of items finds to (row, text, n_words, spans, items);
    with ``cut``, the spans are cut out of the text."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Phrases.of(phrases.value)
        get = block.symbols.get
        for part in parts:
            names = part.schema.names
            texts = part.column(names.index("text"))
            old_spans = part.column(names.index("spans")).to_pylist()
            old_items = part.column(names.index("items")).to_pylist()
            n_words, hits, shard, size = [], [], [], 0
            for cell in texts:
                w = words(cell.as_py())
                n_words.append(len(w))
                symbols = np.fromiter((get(x, 0) for x in w), np.int32, len(w))
                runs = _runs(symbols, block.shortest) if block.shortest else []
                shard.append([(a, b, symbols[a:b]) for a, b in runs])
                size += sum(b - a for a, b in runs) * 8
                if size >= SHARD_BYTES:
                    hits += _search(shard, block)
                    shard, size = [], 0
            hits += _search(shard, block)
            spans = [[list(s) for s in merge_spans([tuple(x) for x in old] + new)]
                     for old, (new, _) in zip(old_spans, hits)]
            items = [sorted(set(old) | new) for old, (_, new) in zip(old_items, hits)]
            if cut:
                texts = pa.array([without_spans(t.as_py(), s) if s else t.as_py()
                                  for t, s in zip(texts, spans)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), texts, pa.array(n_words, pa.int64()),
                 pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                 pa.array(items, pa.list_(pa.string()))], names=names)

    return scan


def find_contamination(docs: DataFrame, items: DataFrame, *, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = 10,
                       keep: Column | None = None, cut: bool = False) -> DataFrame:
    """Rows ``row`` (struct of ``keep``, by default all columns of ``docs``), ``text``
    (with ``cut``, less the spans), ``n_words``, ``spans`` (merged [first word, word
    after]) and ``items`` (ids as strings, in order) for every row of ``docs``."""
    spark = docs.sparkSession
    queries = items.select(col(item_id).cast("string").alias("i"),
                           col(item_text).cast("string").alias("t")).where("t IS NOT NULL")
    size = queries.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    n_blocks = int(size // BLOCK_BYTES) + 1
    none = F.array().cast("array<array<bigint>>")
    out = docs.select((whole_row(docs) if keep is None else keep).alias("row"),
                      col(text).cast("string").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
                      none.alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = out.schema
    for b in range(n_blocks):
        block = queries.where(F.pmod(F.xxhash64("i", "t"), F.lit(n_blocks)) == b)
        # At most about BLOCK_BYTES of text, whatever the number of items.
        rows = sorted((r["i"] or "", r["t"]) for r in block.toLocalIterator())
        phrases = spark.sparkContext.broadcast(vars(Phrases(rows, window)))
        out = out.mapInArrow(trimmed(_pass(phrases, cut and b == n_blocks - 1)), schema)
    return out


def contamination_report(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id",
                         **options) -> DataFrame:
    """Per document row: words, words hit, items with an occurring window."""
    found = find_contamination(docs, items, keep=F.struct(col(doc_id).alias("doc_id")), **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s[1] - s[0])
    return (found.select("row.doc_id", "n_words", n_hit.alias("n_hit"),
                         F.size("items").cast("bigint").alias("n_items"),
                         F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def decontaminated(docs: DataFrame, items: DataFrame, *, text: str = "text",
                   length: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with the removal spans cut out of the texts (``length``, if such a
    column exists, is set to the new number of characters).  A document of which no
    word is left goes; one without a hit stays as it is."""
    out = find_contamination(docs, items, text=text, cut=True, **options)
    hit = F.size("spans") > 0
    left = F.col("n_words") - F.aggregate("spans", F.lit(0).cast("bigint"),
                                          lambda a, s: a + s[1] - s[0])
    out = out.where(~hit | (left > 0))
    return out.select(*[
        F.when(hit, F.col("text")).otherwise(F.col("row").getField(c)).alias(c) if c == text
        else F.when(hit, F.char_length("text").cast(docs.schema[c].dataType))
        .otherwise(F.col("row").getField(c)).alias(c) if c == length
        else F.col("row").getField(c).alias(c) for c in docs.columns])
