"""Which tokens of two tokenizers cover the same bytes, and how often they do so.

Both tokenizers cut the same bytes.  Byte offsets at which a token ends in both cut a
text into groups; an A token and a B token of one group are linked.  A pair of ids
counts the documents that hold it linked.

How it runs:

1. One pass encodes each text by both tokenizers and intersects their lists of token
   ends by galloping: every end of the shorter list looks for its place in the longer
   from that of an end shortly before it, by steps of doubled length, then by halving;
   ends at equal distance from such a one go together.  The common
   ends' ranks in both lists give the groups, their differences the number of tokens in
   each.  Several texts make one run of bytes, as the end of each is common.  A row for
   each document is written, with its digest and its distinct pairs.
2. Pairs are counted by partial aggregation; the best pair of an A id is a maximum over
   at most as many rows as B has ids.
3. Counts go back to the documents: pairs that hold a share of 1 / ``HEAVY`` or more of
   all entries, of which there are at most ``HEAVY``, by broadcast; all others by a
   shuffle, in which no key has more than that share.

Tokenizer files are read by the driver and sent as they are, so workers need none.

Defined cases: null and empty texts, and texts whose joined token bytes of either
tokenizer differ from blank + text (normalised by the tokenizer), have no tokens: zeros
and an empty digest; special tokens in a text are plain text; equal rows are documents
of their own; a text of any length is encoded whole; groups of very many tokens are
counted by distinct ids; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import col, written

#: Characters of text encoded and aligned together, about.
BATCH_CHARS = 400_000
#: Distance of the ends whose places the others start from.
STRIDE = 16
#: Links of a group that are made one by one; larger groups by distinct ids.
GROUP_LINKS = 4096
#: Pairs sent to all workers, at most: those with a share of 1 / HEAVY of all entries.
HEAVY = 1 << 16


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each number of ``short`` the first place in ``long`` whose number is not lower;
    both ascend.  A number starts at the place of one that ``STRIDE`` numbers or fewer
    precede it, goes ahead by steps that double, then halves the last step."""
    n = len(long)
    low = np.zeros(len(short), np.int64)
    if len(short) > STRIDE:
        low = np.repeat(gallop(short[::STRIDE], long), STRIDE)[:len(short)]
    high = low.copy()  # long[low - 1] < number <= long[high], where those places exist
    ahead = np.flatnonzero(high < n)
    ahead = ahead[long[high[ahead]] < short[ahead]]
    step = 1
    while len(ahead):
        low[ahead] = high[ahead] + 1
        high[ahead] = np.minimum(high[ahead] + step, n)
        ahead = ahead[high[ahead] < n]
        ahead = ahead[long[high[ahead]] < short[ahead]]
        step *= 2
    between = np.flatnonzero(low < high)
    while len(between):
        middle = (low[between] + high[between]) >> 1
        less = long[middle] < short[between]
        low[between[less]] = middle[less] + 1
        high[between[~less]] = middle[~less]
        between = between[low[between] < high[between]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the numbers that both hold; the shorter drives."""
    if len(a) > len(b):
        there, here = common_ends(b, a)
        return here, there
    at = gallop(a, b)
    found = np.flatnonzero(at < len(b))
    found = found[b[at[found]] == a[found]]
    return found, at[found]


def group_links(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray,
                limit: int = GROUP_LINKS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    """(group, A id, B id, times) of all links: ids in groups of the given sizes.  Times
    are None if all are 1."""
    a_from, b_from = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes
    small = a_sizes * b_sizes <= limit
    token = np.flatnonzero(np.repeat(small, a_sizes))
    group = np.repeat(np.arange(len(a_sizes)), a_sizes)[token]
    times = b_sizes[group]
    before = np.repeat(np.cumsum(times) - times, times)
    groups = np.repeat(group, times)
    one_by_one = (groups, np.repeat(a[token], times), b[np.arange(len(before)) - before + b_from[groups]])
    if small.all():
        return *one_by_one, None
    parts = [(*one_by_one, np.ones(len(before), np.int64))]
    for g in np.flatnonzero(~small):
        x, x_times = np.unique(a[a_from[g]:a_from[g] + a_sizes[g]], return_counts=True)
        y, y_times = np.unique(b[b_from[g]:b_from[g] + b_sizes[g]], return_counts=True)
        parts.append((np.full(len(x) * len(y), g), np.repeat(x, len(y)), np.tile(y, len(x)),
                      np.outer(x_times, y_times).ravel()))
    return tuple(np.concatenate(p) for p in zip(*parts))


def byte_level(text: str, byte_of: dict[str, int]) -> bytes:
    return bytes(byte_of[c] for c in text)


def byte_alphabet() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: printable Latin-1
    characters stand for themselves, the other bytes in order for those from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokens:
    """A tokenizer's ids: their bytes, lengths and decimal names with what follows them."""

    def __init__(self, data: list[bytes], encode: Callable[[list[str]], list], inside: str, last: str,
                 lossless: bool = False):
        self.data, self.encode, self.lossless = data, encode, lossless
        self.sizes = np.array([len(d) for d in data], np.int64)
        self.inside = np.array([f"{k}{inside}".encode() for k in range(len(data))])
        self.last = np.array([f"{k}{last}".encode() for k in range(len(data))])

    def spells(self, ids, data: bytes) -> bool:
        """Whether the tokens' bytes join to ``data``.  Those of a lossless tokenizer do."""
        return self.lossless or b"".join(map(self.data.__getitem__, ids)) == data


#: The words of a byte-level vocabulary (a fixed value).
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_tokens(file: bytes) -> Tokens:
    """Tokenizer A: byte-level BPE, on a blank and the text.

    A file whose merges are in the order of their ids, with all bytes and no normaliser, is
    encoded by ranks, which gives the same ids several times faster and always spells the
    text: every character is in a word, every byte a token.  Other files are encoded by
    the library they are made for."""
    spec = json.loads(file)
    vocab, byte_of = spec["model"]["vocab"], byte_alphabet()
    special = {t["content"] for t in spec["added_tokens"]}
    ids = {**{t["content"]: t["id"] for t in spec["added_tokens"]}, **vocab}
    data = [b""] * (max(ids.values()) + 1)
    for piece, k in ids.items():
        data[k] = piece.encode() if piece in special else byte_level(piece, byte_of)
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
    words = spec["pre_tokenizer"] or {}
    if (spec["normalizer"] is None and words.get("type") == "ByteLevel" and words.get("use_regex", True)
            and not words["add_prefix_space"] and not spec["model"]["ignore_merges"]
            and [vocab[m] for m in merges] == list(range(256, 256 + len(merges)))
            and all(c in vocab for c in byte_of)):
        from tiktoken import Encoding

        ranks = {data[k]: k for piece, k in vocab.items() if piece not in special}
        by_rank = Encoding("byte-level", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        return Tokens(data, lambda texts: [by_rank.encode_ordinary(" " + t) for t in texts], ",", "|", lossless=True)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file.decode("utf-8"))
    tokenizer.encode_special_tokens = True
    return Tokens(data, lambda texts: [e.ids for e in tokenizer.encode_batch(
        [" " + t for t in texts], add_special_tokens=False)], ",", "|")


def piece_tokens(model: bytes) -> Tokens:
    """Tokenizer B: pieces with byte fallback; it adds the blank itself."""
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_proto=model)
    data = []
    for k in range(processor.get_piece_size()):
        piece = processor.id_to_piece(k)
        data.append(bytes([int(piece[3:5], 16)]) if processor.is_byte(k) else piece.replace("▁", " ").encode())
    return Tokens(data, lambda texts: processor.encode(texts, num_threads=1), ",", ";")


_ROWS = [("row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
         ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
         ("times", pa.list_(pa.int64()))]
_ROWS_SQL = ("row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "pairs array<long>, times array<long>")


def align(texts: list[str | None], a: Tokens, b: Tokens) -> tuple:
    """n_a, n_b, n_groups, n_links, digest for each text, then the distinct pairs of all
    texts with their times and where each text's begin.  A pair is A id × B's ids + B id."""
    some = [k for k, t in enumerate(texts) if t]
    held, ids = [], ([], [])
    for k, x, y in zip(some, a.encode([texts[k] for k in some]), b.encode([texts[k] for k in some])):
        data = b" " + texts[k].encode("utf-8", "surrogatepass")
        if a.spells(x, data) and b.spells(y, data):
            held.append(k)
            ids[0].append(x)
            ids[1].append(y)
    sizes = np.zeros((2, len(texts)), np.int64)
    n_groups, n_links = np.zeros((2, len(texts)), np.int64)
    digests = [""] * len(texts)
    if not held:
        return *sizes, n_groups, n_links, digests, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(
            len(texts) + 1, np.int64)
    for side in (0, 1):
        sizes[side, held] = [len(x) for x in ids[side]]
    x, y = (np.concatenate([np.array(i, np.int64) for i in side]) for side in ids)
    x_end, y_end = common_ends(np.cumsum(a.sizes[x]), np.cumsum(b.sizes[y]))
    x_sizes, y_sizes = np.diff(x_end, prepend=-1), np.diff(y_end, prepend=-1)
    text_of = np.repeat(np.arange(len(texts)), sizes[0])[x_end]
    n_groups = np.bincount(text_of, minlength=len(texts))
    np.add.at(n_links, text_of, x_sizes * y_sizes)

    # Names in order: a group's A ids, then its B ids.
    x_group, y_group = (np.repeat(np.arange(len(s)), s) for s in (x_sizes, y_sizes))
    names = np.empty(len(x) + len(y), dtype=np.promote_types(a.last.dtype, b.last.dtype))
    x_at = np.arange(len(x)) + (np.cumsum(y_sizes) - y_sizes)[x_group]
    y_at = np.arange(len(y)) + np.cumsum(x_sizes)[y_group]
    names[x_at], names[y_at] = a.inside[x], b.inside[y]
    names[x_at[x_end]], names[y_at[y_end]] = a.last[x[x_end]], b.last[y[y_end]]
    begin = 0
    for k in held:
        end = begin + sizes[0, k] + sizes[1, k]
        digests[k] = sha256(names[begin:end].tobytes().replace(b"\0", b"")[:-1]).hexdigest()
        begin = end

    group, left, right, times = group_links(x, y, x_sizes, y_sizes)
    pairs = len(a.data) * len(b.data)
    keys = text_of[group] * pairs + left * len(b.data) + right
    if times is None:
        keys, times = np.unique(keys, return_counts=True)
    else:
        order = np.argsort(keys, kind="stable")
        keys, first = np.unique(keys[order], return_index=True)
        times = np.add.reduceat(times[order], first)
    begins = np.searchsorted(keys, np.arange(len(texts) + 1) * pairs)
    return *sizes, n_groups, n_links, digests, keys % pairs, times, begins


def _aligned(files, batch_chars: int) -> Callable:
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_tokens(files.value[0]), piece_tokens(files.value[1])
        row = TaskContext.get().partitionId() << 40
        for part in parts:
            schema = pa.schema([part.schema.field(0), *_ROWS])
            texts = part.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and chars < batch_chars:
                    chars += len(texts[end] or "") + 1
                    end += 1
                *columns, pairs, times, begins = align(texts[begin:end], a, b)
                lists = [pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(v)) for v in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(begin, end - begin), pa.array(np.arange(row, row + end - begin)),
                     *[pa.array(c) for c in columns], *lists], schema=schema)
                row += end - begin
                begin = end

    return run


def alignment_rows(docs: DataFrame, byte_file: str, piece_file: str, *, doc_id: str = "doc_id", text: str = "text",
                   batch_chars: int = BATCH_CHARS) -> DataFrame:
    """A row for each document: sizes, digest of its groups, distinct pairs with times."""
    files = docs.sparkSession.sparkContext.broadcast(tuple(Path(f).read_bytes() for f in (byte_file, piece_file)))
    read = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    kind = read.schema["doc_id"].dataType.simpleString()
    return read.mapInArrow(_aligned(files, batch_chars), f"doc_id {kind}, {_ROWS_SQL}")


def pair_counts(rows: DataFrame, b_ids: int) -> DataFrame:
    """(pair, documents, best): best if no other pair of its A id is in more documents."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    most = F.max("documents").over(Window.partitionBy(F.expr(f"pair div {b_ids}")))
    return counts.withColumn("best", (F.col("documents") == most).cast("long"))


def alignment_report(docs: DataFrame, byte_file: str, piece_file: str, *, heavy: int = HEAVY,
                     **options) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = written(alignment_rows(docs, byte_file, piece_file, **options))
    counts = written(pair_counts(rows, len(piece_tokens(Path(piece_file).read_bytes()).data)))
    entries = counts.agg(F.sum("documents")).first()[0] or 0
    often = F.col("documents") * heavy >= entries
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    frequent = F.broadcast(counts.where(often))  # at most ``heavy`` rows
    known = links.join(frequent, "pair").unionByName(
        links.join(frequent, "pair", "left_anti").join(counts.where(~often), "pair"))
    sums = known.groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("n_best"),
                                    F.sum(F.col("times") * F.col("documents")).alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return rows.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
