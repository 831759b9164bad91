"""Line dedup by a segment-partition edit join.

Lines (split at \\n) are compared after trimming white space.  A line goes if an equal
line comes earlier, or a similar one.  Similar are two lines of at least ``FUZZY_CHARS``
characters that are at most ``EDITS`` characters apart, or that are apart by at most a
word in ``WORDS_AN_EDIT`` of the longer one (words inserted, deleted or replaced; a word
is a run without ASCII white space).  Earlier means: in a document of lower doc_id (null
last), or before it in the same document; of two similar, different lines the one whose
first document is lower stays, of the same document the one of lower digest.

By pigeonhole, a line within t edits of another contains one of its t + 1 segments,
near its place.  So each line is indexed by its segments, and probes for the segments
of lines of its own length and up to t shorter, at the places that t edits allow.
Candidates are verified by banded bit-parallel edit distance, many pairs at a time.

For words t grows with the line, and t edits leave one of t + 1 runs of words whole: a
run of :func:`whole_run` words.  Of every window of so many words a line enters the
``GRAM`` words of least hash; two lines that share the run share that entry.  (A shorter
line has a smaller window, and enters what larger windows would, and more.)  Candidates
are verified by bit-parallel distance over words.  Lines of ``BY_GRAMS`` words enter their words only: two
edits of characters leave a run of words whole as well, and the windows are no larger than
that run; of ``BY_WORDS`` words, these edits are within their edits of words.

How it runs: index and probe entries are hashes, each with its line, the line's size and the
parities of how many words (or characters) of each kind it has.  Packed by bucket of the hash
they go through one shuffle; only hashes that an index entry and another line share go on, and
of these only lines that sizes and parities allow to be similar to another one there (where up to
``BLOCK`` lines share the hash): where ``FEW`` do, as pairs, else as rows.  Their lines are found
in a second pass over the documents, through a bitmap of fixed size (``BITMAP_BITS``; a
fuller bitmap lets more lines through to the exact join), and sketched: size and
histograms.  Of the lines of these rows only sketches move; pairs whose sketches allow
similarity are made distinct, and the texts of all pairs alone are compared, each pair
once.  A hash that many lines share (of hashes that the same lines share, one is enough) is
split into blocks, of lines of like size where it is words.  A block gives each line its earliest candidate there
or of the ``FIRST`` first lines of its hash, which stand in all blocks: of a group of near copies
these are most often the text that the others come from.  (Of its hashes of several blocks two do so for a line.)  Lines
that are not similar to it meet all blocks of like size, or, where a hash of words has over
``MET`` times ``BLOCK`` lines, those that share one of their rarest ``GRAM`` words
(:func:`enough`), whatever number shares the frequent ones, and those with candidates still, but no similar line, all
candidates, each once as far as the ``LEAST`` least hashes tell: so neither a group of similar lines nor a phrase in many lines costs pairs
beyond proportion to its lines.
Decisions are by line digest and document; texts move only where documents are rewritten.

Defined cases: a null text has no line; blank lines are never removed; documents of
equal doc_id and text are decided alike (a copy within the id keeps what the first
keeps); a document whose lines are all removed or blank, of which at least one was
removed, goes from :func:`deduplicated` (it holds nothing that others don't).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import batches, col, settle, trimmed, tuples
from tillflow.llm.near_text import edit_distance_within
from tillflow.plans.scratch import kept

EDITS = 2
#: An edited word is allowed for so many words of the longer line.
WORDS_AN_EDIT = 10
#: Words of an entry.
GRAM = 5
FUZZY_CHARS = 24
#: An edit of a character edits two words at most (it joins or parts them).  Lines of so
#: many words, and those within ``EDITS`` of them, are thus within the edits of words.
BY_WORDS = 2 * EDITS * WORDS_AN_EDIT + EDITS
#: Of a line of so many words the runs that edits of characters leave whole have a gram, and
#: lines within ``EDITS`` of it are of its class of size or of one next to it.
BY_GRAMS = 20
#: Bits of the bitmap of candidate lines: 8 MB, whatever the input.
BITMAP_BITS = 1 << 26
#: Lines of a block, on average, where many share a segment.
BLOCK = 1024
#: Blocks of lines that share words up to which an open line meets them all; so many blocks of
#: open lines meet the others at once.
MET = 1
#: Lines of a hash, the first ones of some of its blocks, that all its blocks meet.
FIRST = 4
#: Frequent grams that are told apart, by their counts in one of so many lines.
COMMON, COUNTED = 1 << 17, 8
LAST = (1 << 63) - 1
#: Hashes of words of a line, its least, by which a pair that meets in several of them is told once.
LEAST = 16

INDEX, PROBE, WORDS = 0, 1, 2


def digest(line: str) -> tuple[int, int]:
    """128 bits of a line, as two signed numbers."""
    d = hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def digests(lines: list[str]) -> np.ndarray:
    """:func:`digest` of many lines, a row each."""
    new = hashlib.blake2b
    raw = b"".join([new(x.encode("utf-8", "surrogatepass"), digest_size=16).digest() for x in lines])
    return np.frombuffer(raw, ">i8").astype(np.int64).reshape(-1, 2)


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, size) of the edits + 1 segments of a line: sizes differ by one at most."""
    n = edits + 1
    short, longer = length // n, length % n
    out, at = [], 0
    for k in range(n):
        size = short + (k >= n - longer)
        out.append((at, size))
        at += size
    return out


def entries(length: int, edits: int = EDITS) -> list[tuple[int, int, int, int, int]]:
    """(kind, indexed length, segment, start, size) of what a line of this length
    enters.  An index entry is a probe for its own length as well."""
    out = []
    for shorter in range(edits + 1):
        own = length - shorter
        for k, (start, size) in enumerate(segments(own, edits)):
            low = max(0, start - k, start + shorter - (edits - k))
            high = min(length - size, start + k, start + shorter + (edits - k))
            for at in range(low, high + 1):
                kind = INDEX if shorter == 0 and at == start else PROBE
                out.append((kind, own, k, at, size))
    return out


def edits_within(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray, most: int = EDITS) -> np.ndarray:
    """For pairs of lines (rows of code points, 0-padded) with la >= lb: whether at
    most ``most`` edits apart.  Bit-parallel over a band of 2 * most + 1 diagonals,
    one column of all pairs at a time."""
    one = np.uint64(1)
    out = np.zeros(len(la), bool)
    rows = np.flatnonzero(la - lb <= most)
    if not len(rows):
        return out
    a, la, b, lb = a[rows], la[rows].astype(np.int64), b[rows], lb[rows].astype(np.int64)
    width = max(int(la.max()), int(lb.max())) + 2 * most + 2
    pad = np.zeros((len(rows), width + most), a.dtype)
    pad[:, most:most + a.shape[1]] = a  # place i of a stands at most + i
    top = np.uint64(2 * most)
    vp = np.full(len(rows), sum(1 << (2 * most - k) for k in range(most + 1)), np.uint64)
    vn = np.zeros(len(rows), np.uint64)
    mask = np.uint64((1 << (2 * most + 1)) - 1)
    dist = np.full(len(rows), most, np.int64)
    bar = np.full(len(rows), 2 * most, np.int64)  # bit of the last row of a, once it is in the band
    live = np.arange(len(rows))
    for j in range(int(lb.max())):
        live = live[lb[live] > j]
        if not len(live):
            break
        ch = b[live, j]
        pm = np.zeros(len(live), np.uint64)
        for k in range(2 * most + 1):
            # bit k is row j - most + k of a; padding is 0 and never equals a character
            pm |= (pad[live, j + k] == ch).astype(np.uint64) << np.uint64(k)
        p, n = vp[live], vn[live]
        d0 = ((((pm & p) + p) ^ p) | pm | n) & mask
        hp = (n | ~(d0 | p)) & mask
        hn = d0 & p
        diagonal = la[live] - most > j
        dist[live] += np.where(diagonal, 1 - ((d0 >> top) & one).astype(np.int64), 0)
        flat = ~diagonal
        if flat.any():
            bar[live[flat]] -= 1
            at = bar[live].clip(0).astype(np.uint64)
            dist[live] += np.where(flat, ((hp >> at) & one).astype(np.int64)
                                   - ((hn >> at) & one).astype(np.int64), 0)
        down = d0 >> one
        vp[live] = (hn | ~(down | hp)) & mask
        vn[live] = down & hp
        if j % 8 == 7:  # on the diagonal the count never falls; later it may, by most
            live = live[dist[live] <= 3 * most]
    out[rows] = (dist <= most)
    return out


# -- edits of words ----------------------------------------------------------------

def word_edits(n: int) -> int:
    """Edits allowed to a line of ``n`` words and one that isn't longer."""
    return n // WORDS_AN_EDIT


def whole_run(n: int) -> int:
    """Words in a row that a line of ``n`` words or any longer one shares with every
    line that isn't longer and within its edits.  With t edits n - t words stay, in
    t + 1 runs at most; the least of it is found within the next lengths, as a longer
    line of as many words over a multiple has longer runs."""
    return min(-(-(m - word_edits(m)) // (word_edits(m) + 1)) for m in range(n, n + 2 * WORDS_AN_EDIT))


def char_run(n: int) -> int:
    """As :func:`whole_run`, where ``EDITS`` characters differ and the longer line has
    ``BY_GRAMS`` words at least: an edit takes two words that stand together at most."""
    return -(-(max(n, BY_GRAMS) - 2 * EDITS) // (EDITS + 1))


def enough(n):
    """Grams, the first in one order of all grams, of which a line of ``n`` words shares one
    with every line within its edits.  The longest of those has n + n // 9 words and n // 9
    edits, and an edit takes ``GRAM`` grams at most (of a character one more, of two words); of the grams that stay the first one
    comes after no more than those in either line."""
    return np.maximum(GRAM * (n // (WORDS_AN_EDIT - 1)), EDITS * (GRAM + 1)) + 1


_WINDOWS = np.array([0] * (WORDS_AN_EDIT - 1) + [min(whole_run(n), char_run(n)) - GRAM + 1
                                                 for n in range(WORDS_AN_EDIT - 1, 1000)])
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_random = np.random.default_rng(8)
_BYTES = _random.integers(1, 1 << 63, 256, np.uint64)
_PLACES = _random.integers(1, 1 << 63, GRAM, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
#: Bytes of lines hashed together, and words of the pieces that longer lines are cut to.
CHUNK, PIECE = 1 << 18, 50_000


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


#: An entry without its bucket: hash and kind (48 bits), line, its words or characters, their parities.
ENTRY = np.dtype([("low", "<u4"), ("high", "<u2"), ("line", "<i8"), ("size", "<u2"), ("parity", "<u8")])
#: Parts that entries are dealt to by hash, and a size that is not known.
BUCKETS, UNKNOWN = 1 << 12, 0xFFFF


def parities(kind: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` lines 64 bits: whether it has an odd number of each kind (0 to 63)."""
    out = np.zeros(n, np.uint64)
    begin = np.flatnonzero(np.diff(line, prepend=-1))
    if len(begin):
        out[line[begin]] = np.bitwise_xor.reduceat(np.uint64(1) << kind.astype(np.uint64), begin)
    return out


def packed(entry: np.ndarray, line: np.ndarray, size: np.ndarray, parity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and rows of entries (hash, the last three bits the kind)."""
    rows = np.empty(len(entry), ENTRY)
    rows["low"], rows["high"] = entry & np.uint64(0xFFFFFFFF), entry >> np.uint64(32) & np.uint64(0xFFFF)
    rows["line"], rows["size"], rows["parity"] = line, size, parity
    return (entry >> np.uint64(52)).astype(np.uint16), rows


class WordHashes:
    """Hashes of the words of many lines at a time."""

    def __init__(self):
        self.powers = self.back = np.zeros(0, np.uint64)

    def of(self, lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, and the number of its line."""
        data = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8) if lines else np.zeros(0, np.uint8)
        length = np.array([len(x) + 1 for x in lines], np.int64)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space))))
        begin, end = edge[::2], edge[1::2]
        if len(data) > len(self.powers):
            self.powers, self.back = _powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * self.powers[:len(data)], dtype=np.uint64)))
        return (_mixed((total[end] - total[begin]) * self.back[begin]),
                np.repeat(np.arange(len(lines)), length)[begin])


class WordEntries:
    """Gathers lines, and gives the hashes of the grams that they enter."""

    def __init__(self):
        self.lines: list[bytes] = []
        self.ids: list[int] = []
        self.sizes: list[int] = []  # words of the whole line, where this is a piece
        self.chars = 0
        self.hashes = WordHashes()

    def add(self, line: bytes, own: int) -> bool:
        """True when it is time to take the entries."""
        if len(line) > CHUNK:
            w = line.split()
            for at in range(0, max(1, len(w) - 16), PIECE):  # a window is of less than 16 words
                self._add(b" ".join(w[at:at + PIECE + 16]), own, len(w))
        else:
            self._add(line, own, 0)
        return self.chars >= CHUNK

    def _add(self, line: bytes, own: int, size: int):
        self.lines.append(line)
        self.ids.append(own)
        self.sizes.append(size)
        self.chars += len(line) + 1

    def _grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the lines gathered: the hash (odd) of the gram that begins at each word, the
        number of each word's line, and words, ids and parities (0 for pieces) of the lines."""
        ids, sizes = np.array(self.ids, np.int64), np.array(self.sizes, np.int64)
        word, line = self.hashes.of(self.lines)
        parity = parities(word >> np.uint64(58), line, len(ids))
        parity[sizes > 0] = 0
        self.lines, self.ids, self.sizes, self.chars = [], [], [], 0
        n = np.bincount(line, minlength=len(ids))
        n = np.where(sizes > 0, sizes, n)
        grams = max(0, len(word) - GRAM + 1)
        gram = np.zeros(grams, np.uint64)
        for j in range(GRAM):
            gram += word[j:j + grams] * _PLACES[j]
        return _mixed(gram) | np.uint64(1), line, n, ids, parity

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """(hash, line) of the entries of the lines gathered; their hashes are odd."""
        value, own, ids, _, _ = self._taken()
        return value.view(np.int64), ids[own]

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """:func:`packed` entries of the lines gathered."""
        whole = np.array(self.sizes, np.int64) == 0
        value, own, ids, n, parity = self._taken()
        size = np.where(whole, np.minimum(n, UNKNOWN), UNKNOWN)
        return packed(value & ~np.uint64(7) | np.uint64(WORDS | 4), ids[own], size[own], parity[own])

    def _taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash and number of the line of each entry, and ids, words and parities of the lines."""
        gram, line, n, ids, parity = self._grams()
        grams = len(gram)
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), ids, n, parity
        if not grams:
            return none
        window = _WINDOWS[np.minimum(n, len(_WINDOWS) - 1)][line]
        least = gram
        found, of = [], []
        for w in range(1, int(window.max()) + 1):
            if w > 1:
                if grams < w:
                    break
                least = np.minimum(least[:grams - w + 1], gram[w - 1:])
            at = np.flatnonzero((window[:len(least)] == w) & (line[:len(least)] == line[GRAM + w - 2:]))
            if len(at):
                value, own = least[at], line[at]
                new = np.concatenate(([True], (value[1:] != value[:-1]) | (own[1:] != own[:-1])))
                found.append(value[new])
                of.append(own[new])
        return (np.concatenate(found), np.concatenate(of), ids, n, parity) if found else none

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, number of the line, words of the line) of every gram of the lines gathered."""
        gram, line, n, _, _ = self._grams()
        at = np.flatnonzero(line[:len(gram)] == line[GRAM - 1:]) if len(gram) else np.zeros(0, np.int64)
        return gram[at], line[at], n[line[at]]

    def rarest(self, common: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, line) of the :func:`enough` rarest grams of each line gathered.  ``common``
        (sorted) are frequent grams, ``often`` how frequent; others are rarer, by hash."""
        ids = np.array(self.ids, np.int64)
        gram, line, n = self.whole()
        rank = np.zeros(len(gram), np.int64)
        if len(common):
            at = np.minimum(np.searchsorted(common, gram), len(common) - 1)
            rank = np.where(common[at] == gram, often[at], 0)
        order = np.lexsort((gram, rank, line))
        gram, line, n = gram[order], line[order], n[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (line[1:] != line[:-1])
        gram, line, n = gram[new], line[new], n[new]
        few = np.arange(len(line)) - np.searchsorted(line, line) < enough(n)
        return gram[few].view(np.int64), ids[line[few]]


class SegmentEntries:
    """Gathers lines, and gives the hashes of the segments that they enter."""

    def __init__(self):
        self.lines: list[str] = []
        self.ids: list[int] = []
        self.chars = 0
        self.plans: dict[int, np.ndarray] = {}
        self.powers = self.back = np.zeros(0, np.uint64)

    def add(self, line: str, own: int) -> bool:
        """True when it is time to take the entries."""
        self.lines.append(line)
        self.ids.append(own)
        self.chars += len(line)
        return self.chars >= CHUNK

    def _plan(self, n: int) -> np.ndarray:
        """Rows (salt, kind, begin, end) of what a line of ``n`` characters enters."""
        if n not in self.plans:
            if len(self.plans) > 50_000:
                self.plans.clear()
            self.plans[n] = np.array([(length << 8 | k, kind, at, at + size)
                                      for kind, length, k, at, size in entries(n)], np.int64).reshape(-1, 4)
        return self.plans[n]

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """:func:`packed` entries of the lines gathered."""
        lines, ids = self.lines, np.array(self.ids, np.int64)
        self.lines, self.ids, self.chars = [], [], 0
        length = np.array([len(x) for x in lines], np.int64)
        codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
        parity = parities(codes & np.uint32(63), np.repeat(np.arange(len(lines)), length), len(lines))
        hashes, kinds, of = [], [], []
        for k in np.flatnonzero(length > CHUNK).tolist():  # the powers of so long a line are not kept
            for salt, kind, at, end in self._plan(len(lines[k])).tolist():
                if salt >> 8 > CHUNK:
                    hashes.append(np.array([xxhash.xxh3_64_intdigest(lines[k][at:end].encode("utf-8", "surrogatepass"),
                                                                     salt & 0xFFFFFFFF)], np.uint64))
                    kinds.append(np.array([kind]))
                    of.append(np.array([k]))
        begin = np.cumsum(length) - length
        near = np.flatnonzero(length <= CHUNK + EDITS)
        for at in np.array_split(near, max(1, int(length[near].sum()) // (2 * CHUNK))):
            if not len(at):
                continue
            plans = [self._plan(n) for n in length[at].tolist()]
            plan = np.concatenate(plans)
            line = np.repeat(at, [len(p) for p in plans])
            here = plan[:, 0] >> 8 <= CHUNK
            plan, line = plan[here], line[here]
            if not len(plan):
                continue
            low, high = int(begin[at[0]]), int(begin[at[-1]] + length[at[-1]])
            if high - low > len(self.powers):
                self.powers, self.back = _powers(_BASE, high - low), _powers(pow(_BASE, -1, 1 << 64), high - low)
            value = _mixed(codes[low:high].astype(np.uint64) * np.uint64(_BASE) + np.uint64(_BASE))
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * self.powers[:high - low], dtype=np.uint64)))
            first, last = begin[line] - low + plan[:, 2], begin[line] - low + plan[:, 3]
            hashes.append(_mixed(_mixed((total[last] - total[first]) * self.back[first])
                                 + plan[:, 0].view(np.uint64) * np.uint64(_BASE)))
            kinds.append(plan[:, 1])
            of.append(line)
        if not hashes:
            return packed(np.zeros(0, np.uint64), ids[:0], ids[:0], parity[:0])
        value, kind, own = np.concatenate(hashes), np.concatenate(kinds).astype(np.uint64), np.concatenate(of)
        return packed(value & ~np.uint64(7) | kind, ids[own], np.minimum(length, UNKNOWN)[own], parity[own])


# -- candidates and their verification ------------------------------------------------

BINS, CHAR_BINS = 64, 32
#: Cells of a matrix of lines compared together.
CELLS = 1 << 20
#: Words from which on only the diagonals within the edits are followed.
BY_LIST = 5000


def sketches(lines: list[str], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, characters, and how many of each kind (by hash, counts up to 255) of each line.
    An edit changes two counts by one at most, or one and the number of words or characters."""
    words, line = hashes.of([x.encode("utf-8", "surrogatepass") for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.array([len(x) for x in lines], np.int64)
    n = len(lines)
    counts = np.bincount(line * BINS + (words & np.uint64(BINS - 1)).astype(np.int64), minlength=n * BINS)
    of_chars = np.bincount(np.repeat(np.arange(n), chars) * CHAR_BINS + (codes & (CHAR_BINS - 1)), minlength=n * CHAR_BINS)
    bins = np.concatenate([counts.reshape(n, BINS), of_chars.reshape(n, CHAR_BINS)], axis=1)
    return np.bincount(line, minlength=n), chars, np.minimum(bins, 255).astype(np.uint8)


def near_sketches(group: np.ndarray, role: np.ndarray, kind: np.ndarray, line: np.ndarray, words: np.ndarray,
                  chars: np.ndarray, bins: np.ndarray, every: bool, segment: np.ndarray | None = None,
                  least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows (late, early) of one group, of different lines, whose sketches may be those of
    similar lines.  Rows stand in order of the line within their group; role 1 may be
    early, 2 late, 3 both.  ``every``: all such pairs, else the earliest for each late row; where
    ``least`` holds hashes of words of each row's line, a pair is left out that meets in a lower one."""
    best = np.full(len(group), -1)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    left = np.arange(len(group))
    d = 1
    while len(left):
        left = left[left + d < len(group)]
        left = left[group[left + d] == group[left]]
        a = left[(role[left] & 1 > 0) & (role[left + d] & 2 > 0)]
        b = a + d
        by_words = kind[a] == WORDS
        ok = (line[a] != line[b]) & (by_words | (kind[a] == INDEX) | (kind[b] == INDEX))
        a, b, by_words = a[ok], b[ok], by_words[ok]
        longer = np.maximum(words[a], words[b])
        near = np.zeros(len(a), bool)
        # Few words or, in lines where these are not so few words, few characters may differ.
        for of, size, part, most in ((by_words, words, slice(0, BINS), longer // WORDS_AN_EDIT),
                                     (~by_words | (longer < BY_WORDS), chars, slice(BINS, None), np.full(len(a), EDITS))):
            apart = np.abs(size[a] - size[b])
            at = np.flatnonzero(of & ~near & (apart <= most))
            near[at] = (np.abs(bins[a[at], part].astype(np.int16) - bins[b[at], part]).sum(axis=1)
                        + apart[at] <= 2 * most[at])
        a, b = a[near], b[near]
        if least is not None and len(a):
            common = ((least[a][:, :, None] == least[b][:, None, :]) & (least[a] < segment[a][:, None])[:, :, None]).any(axis=(1, 2))
            a, b = a[~common], b[~common]
        best[b] = a  # of growing distance: the earliest stays
        if every:
            found.append((b, a))
        d += 1
    if every:
        return tuple(np.concatenate(c) for c in zip(*found)) if found else (best[:0], best[:0])
    late = np.flatnonzero(best >= 0)
    return late, best[late]


def _matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.uint32)
    for to, x in zip(out, rows):
        to[:len(x)] = x
    return out


def pairs_within(pairs: list[tuple[np.ndarray, np.ndarray]], most: int) -> np.ndarray:
    """Whether the sequences (of numbers from 1 on) of each pair are ``most`` edits apart
    at most, many pairs of like length together."""
    out = np.zeros(len(pairs), bool)
    if 2 * most + 1 > 63:  # wider than a machine word
        for k, (x, y) in enumerate(pairs):
            a, b = (x, y) if len(x) >= len(y) else (y, x)
            out[k] = edit_distance_within(a.tolist(), b.tolist(), most) >= 0
        return out
    order = sorted(range(len(pairs)), key=lambda k: max(len(pairs[k][0]), len(pairs[k][1])))
    begin = 0
    while begin < len(order):
        end = begin + 1  # as many pairs as fit a matrix of the last one's width
        while end < len(order) and (end + 1 - begin) * max(map(len, pairs[order[end]])) <= CELLS:
            end += 1
        both = [sorted(pairs[k], key=len, reverse=True) for k in order[begin:end]]
        width = max(len(a) for a, _ in both)
        sizes = [np.array([len(p[side]) for p in both]) for side in (0, 1)]
        out[order[begin:end]] = edits_within(_matrix([a for a, _ in both], width), sizes[0],
                                             _matrix([b for _, b in both], width), sizes[1], most)
        begin = end
    return out


def _parted(x, y) -> tuple:
    """Two sequences without what both begin with and what both end with: as many edits."""
    low, least = 0, min(len(x), len(y))
    while low < least and x[low] == y[low]:
        low += 1
    end = 0
    while end < least - low and x[-1 - end] == y[-1 - end]:
        end += 1
    return x[low:len(x) - end], y[low:len(y) - end]


def apart_by(x: list, y: list, most: int) -> bool:
    """Whether two sequences are ``most`` edits apart at most: bit-parallel, one element of y
    at a time against all of x."""
    if not x or not y:
        return max(len(x), len(y)) <= most
    places: dict = {}
    for k, w in enumerate(x):
        places[w] = places.get(w, 0) | 1 << k
    mask, last = (1 << len(x)) - 1, 1 << (len(x) - 1)
    vp, vn, dist = mask, 0, len(x)
    for left, w in zip(range(len(y) - 1, -1, -1), y):
        pm = places.get(w, 0)
        d0 = ((((pm & vp) + vp) ^ vp) | pm | vn) & mask
        hp, hn = (vn | ~(d0 | vp)) & mask, d0 & vp
        if hp & last:
            dist += 1
        elif hn & last:
            dist -= 1
        if dist - left > most:
            return False
        hp = hp << 1 | 1
        vp, vn = (hn << 1 | ~(d0 | hp)) & mask, d0 & hp & mask
    return dist <= most


def similar_texts(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Whether the lines of each pair are similar, by characters or by words."""
    out = np.zeros(len(pairs), bool)
    by_chars = []
    for k, (x, y) in enumerate(pairs):
        a, b = (t.encode("utf-8", "surrogatepass").split() for t in (x, y))
        longer = max(len(a), len(b))
        most = word_edits(longer)
        if most and abs(len(a) - len(b)) <= most:
            a, b = _parted(a, b)
            out[k] = apart_by(a, b, most) if longer < BY_LIST else edit_distance_within(a, b, most) >= 0
        if not out[k] and longer < BY_WORDS and abs(len(x) - len(y)) <= EDITS:
            by_chars.append(k)
    codes = [tuple(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) + 1 for t in _parted(*pairs[k]))
             for k in by_chars]
    out[by_chars] = pairs_within(codes, EDITS)
    return out


# -- passes over the documents -----------------------------------------------------

def _lines(text: str | None) -> list[str]:
    return [x.strip() for x in text.split("\n")] if text is not None else []


_OCCURRENCE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()),
                         ("version", pa.int64()), ("place", pa.int32()), ("again", pa.bool_()), ("n", pa.int64())])


def _occurrences(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line that isn't blank: digest, document, place, whether the same document has
    it before, and with the first one of a document their number."""
    held: list[tuple] = []
    lines: list[str] = []
    chars = 0

    def taken() -> pa.RecordBatch:
        h = digests(lines)
        of = [len(places) for _, _, places, _ in held]
        columns = [h[:, 0], h[:, 1], np.repeat(np.array([d for d, _, _, _ in held], np.int64), of),
                   np.repeat(np.array([v for _, v, _, _ in held], np.int64), of),
                   [p for _, _, places, _ in held for p in places], [x for _, _, _, again in held for x in again],
                   [n for k in of for n in (k, *[None] * (k - 1))]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OCCURRENCE)], schema=_OCCURRENCE)

    for doc, version, text in tuples(parts):
        all_lines = _lines(text)
        places = [k for k, x in enumerate(all_lines) if x]
        if not places:
            continue
        own = [all_lines[k] for k in places]
        again = [False] * len(own)
        if len(set(own)) < len(own):
            seen: set[str] = set()
            for k, x in enumerate(own):
                again[k] = x in seen
                seen.add(x)
        held.append((doc, version, places, again))
        lines += own
        chars += len(text)
        if len(lines) >= 20_000 or chars >= 1 << 23:
            yield taken()
            held, lines, chars = [], [], 0
    if held:
        yield taken()


#: Entries that a task deals out or looks at together.
ROWS = 1 << 20


def _dealt(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Packed entries as rows (bucket, entries)."""
    bucket, rows = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(bucket, kind="stable")
    bucket, rows = bucket[order], np.take(rows.view(np.uint32).reshape(-1, ENTRY.itemsize // 4), order, axis=0)
    begin = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
    end = np.append(begin[1:], len(rows))
    for k in range(0, len(begin), 256):
        at, to = int(begin[k]), int(end[k:k + 256][-1])
        offsets = np.append(begin[k:k + 256], to) - at
        blobs = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
            None, pa.py_buffer((offsets * ENTRY.itemsize).astype(np.int32)), pa.py_buffer(rows[at:to].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(bucket[begin[k:k + 256]].astype(np.int32)), blobs], names=["bucket", "entries"])


def _entries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, entries): what each line enters; lines met before in this
    task are left out as far as a bounded memory goes."""
    seen: set[int] = set()
    by_words, by_chars = WordEntries(), SegmentEntries()
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def full() -> bool:
        return sum(len(x) for x, _ in held) >= ROWS

    for part in parts:
        for cell in part.column(2):
            for line in _lines(cell.as_py()):
                if len(line) < FUZZY_CHARS:
                    continue
                data = line.encode("utf-8", "surrogatepass")
                own = int.from_bytes(hashlib.blake2b(data, digest_size=16).digest()[:8], "big", signed=True)
                if own in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(own)
                taken = [by_words] if by_words.add(data, own) else []
                if len(data.split(None, BY_GRAMS - 1)) < BY_GRAMS:
                    taken += [by_chars] if by_chars.add(line, own) else []
                if taken:
                    held += [x.packed() for x in taken]
                    if full():
                        yield from _dealt(held)
                        held = []
    yield from _dealt([*held, by_words.packed(), by_chars.packed()])


def near_entries(segment: np.ndarray, kind: np.ndarray, line: np.ndarray, size: np.ndarray, parity: np.ndarray,
                 few: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows in order of their hash: which have another line there that may be similar by sizes and
    parities, and, of the rows of ``few``, all such pairs instead.  An edit changes two parities
    at most, or one and the size; of a character, it changes three parities of words at most, and
    their number by one."""
    near = np.zeros(len(segment), bool)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    size = size.astype(np.int32)
    left = np.arange(len(segment))
    d = 1
    while len(left):
        left = left[left + d < len(segment)]
        left = left[segment[left + d] == segment[left]]
        a = left[~(near[left] & near[left + d])]
        b = a + d
        longer, apart = np.maximum(size[a], size[b]), np.abs(size[a] - size[b])
        odd = np.bitwise_count(parity[a] ^ parity[b]).astype(np.int32)
        words = kind[a] == WORDS
        most = np.where(words, longer // WORDS_AN_EDIT, EDITS)
        ok = (apart <= most) & (odd + apart <= 2 * most)
        ok |= words & (longer >= BY_GRAMS) & (longer < BY_WORDS) & (apart <= EDITS) & (odd <= 3 * EDITS)
        ok |= longer == UNKNOWN
        ok &= (line[a] != line[b]) & (words | (kind[a] == INDEX) | (kind[b] == INDEX))
        a, b = a[ok], b[ok]
        paired = few[a]
        pairs.append((a[paired], b[paired]))
        near[a[~paired]] = near[b[~paired]] = True
        d += 1
    return (near, *(np.concatenate(x) for x in zip(*pairs))) if pairs else (near, left, left)


#: Lines of a hash up to which their pairs go on, and a kind and hash for these.
FEW, PAIR, NONE = 8, 3, -1


def _live_entries(most: int) -> object:
    """Task: packed entries sorted by bucket -> those of hashes that have an index entry (or are words,
    where all entries are alike) and a second line; where up to ``most`` lines share the hash, of
    lines that may have a similar one there; where ``FEW`` do, pairs of such lines.  Some buckets at
    a time; of a bucket too large for that the hashes of more lines go on at once."""
    schema = pa.schema([("segment", pa.int64()), ("kind", pa.int8()), ("line", pa.int64()), ("other", pa.int64())])

    def taken(key: np.ndarray, rows: np.ndarray, frequent: np.ndarray, whole: bool) -> tuple:
        """Live rows; entries that stay (not ``whole``: more of them come), and hashes that are live."""
        out = []

        def add(key, line):
            out.append((key >> 2, key & 3, line, line))

        if len(frequent):
            at = np.isin(key >> 2, frequent)
            add(key[at], rows["line"][at])
            key, rows = key[~at], rows[~at]
        if whole:  # most hashes stand alone
            order = np.argsort(key)
            segment = key[order] >> 2
            same = segment[1:] == segment[:-1]
            order = order[np.append(False, same) | np.append(same, False)] if len(order) else order
            key, rows = key[order], rows[order]
        order = np.lexsort((key, rows["line"], key >> 2))
        key, rows = key[order], rows[order]
        segment, line = key >> 2, rows["line"]
        new = np.ones(len(key), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (line[1:] != line[:-1])  # of a line's entries the index one
        key, rows, segment = key[new], rows[new], segment[new]
        begin = np.flatnonzero(np.diff(segment, prepend=-1))
        n = np.diff(np.append(begin, len(key)))
        live = np.logical_or.reduceat(key & 3 != PROBE, begin) & (n > 1) if len(begin) else np.zeros(0, bool)
        many = np.repeat(live & (n > most), n)
        add(key[many], rows["line"][many])
        stay, again = ~many & (not whole), np.unique(segment[many])
        if whole:
            at = np.repeat(live & (n <= most), n)
            some, own = key[at], rows[at]
            near, a, b = near_entries(some >> 2, some & 3, own["line"], own["size"], own["parity"], np.repeat(n <= FEW, n)[at])
            add(some[near], own["line"][near])
            out.append((np.full(len(a), NONE), np.full(len(a), PAIR), own["line"][a], own["line"][b]))  # lines in order
        return (pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(f.type.to_pandas_dtype()))
                                            for c, f in zip(zip(*out), schema)], schema=schema),
                key[stay], rows[stay], again)

    def live(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, frequent = np.zeros(0, np.int64), np.zeros(0, ENTRY), np.zeros(0, np.int64)
        bound = 2 * ROWS
        for part in parts:
            for at in range(0, part.num_rows, 2048):
                column = part.column(1).slice(at, 2048)
                ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
                new = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(ENTRY)
                bucket = np.repeat(part.column(0).to_numpy()[at:at + 2048].astype(np.int64), np.diff(ends) // ENTRY.itemsize)
                new_key = new["low"].astype(np.int64) | new["high"].astype(np.int64) << 32 | bucket << 48
                key, rows = np.concatenate((key, new_key)), np.concatenate((rows, new))
                if len(key) < ROWS:
                    continue
                last = key >> 48 == key[-1] >> 48
                if not last.all():  # all but the last bucket are whole
                    yield taken(key[~last], rows[~last], frequent, True)[0]
                    key, rows, frequent, bound = key[last], rows[last], frequent[:0], 2 * ROWS
                if len(key) >= bound:
                    batch, key, rows, again = taken(key, rows, frequent, False)
                    yield batch
                    frequent, bound = np.union1d(frequent, again), max(2 * ROWS, 2 * len(key))
        yield taken(key, rows, frequent, True)[0]

    return live


def _entry_batch(keys, kinds, ids) -> pa.RecordBatch:
    """Hash and kind in one number, which sorts by hash, then kind.  The third bit parts
    segments from words: they never meet."""
    key = np.array(keys, np.uint64) & ~np.uint64(7) | np.array(kinds, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.array(ids, np.int64))],
                                      names=["entry", "line"])


def _live(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of entries sorted by segment and kind, those of segments that have an index
    entry (or are words, where all entries are alike) and a second line.  One row is held over from batch to batch."""
    schema = pa.schema([("segment", pa.int64()), ("kind", pa.int8()), ("line", pa.int64())])
    current, has_index, held, live = None, False, None, False

    for part in parts:
        entry, line = part.column(0).to_numpy(), part.column(1).to_numpy()
        seg, kind = entry >> 2, entry & 3
        if not len(seg):
            continue
        # Rows whose segment stands alone can't be live: leave them out at once.
        same = seg[1:] == seg[:-1]
        inner = np.concatenate(([seg[0] == current if current is not None else False], same)) \
            | np.concatenate((same, [True]))
        out = []
        for s, k, x in zip(seg[inner].tolist(), kind[inner].tolist(), line[inner].tolist()):
            if s != current:
                current, has_index, held, live = s, k != PROBE, (s, k, x), False
            elif not has_index:
                continue
            elif live:
                out.append((s, k, x))
            elif x != held[2]:
                live = True
                out += [held, (s, k, x)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in out], f.type) for c, f in enumerate(schema)], schema=schema)


def _found_lines(bitmap) -> object:
    """Task: lines whose digest is in the bitmap, with their digest."""
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("line", pa.string())])

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)

        def taken() -> pa.RecordBatch:
            h = digests(lines)
            at = np.flatnonzero(_has(bits, h[:, 0]))
            return pa.RecordBatch.from_arrays([pa.array(h[at, 0]), pa.array(h[at, 1]), pa.array(np.array(docs, np.int64)[at]),
                                               pa.array([lines[k] for k in at.tolist()], pa.string())], schema=schema)

        lines: list[str] = []
        docs: list[int] = []
        chars = 0
        for doc, _, text in tuples(parts):
            own = [x for x in set(_lines(text)) if len(x) >= FUZZY_CHARS]
            lines += own
            docs += [doc] * len(own)
            chars += len(text or "")
            if len(lines) >= 10_000 or chars >= 1 << 23:
                yield taken()
                lines, docs, chars = [], [], 0
        if lines:
            yield taken()

    return scan


def _has(bits: np.ndarray, number):
    at = number & (BITMAP_BITS - 1)
    return (bits[at >> 3] >> (at & 7) & 1) > 0


def bitmap_of(lines: DataFrame, name: str = "line") -> bytes:
    """A bitmap of the numbers in a column, modulo ``BITMAP_BITS``."""
    at = F.pmod(F.col(name), F.lit(BITMAP_BITS))
    size = 4096 * 8
    pieces = (lines.select(F.floor(at / size).cast("int").alias("piece"), (at % size).cast("bigint").alias("bit"))
              .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = bytearray(BITMAP_BITS // 8)
    for r in pieces.collect():  # in one job; at most BITMAP_BITS / 32,768 rows of 4 KB
        out[r["piece"] * 4096:(r["piece"] + 1) * 4096] = r["bits"]
    return bytes(out)


_SKETCHED = ("h1 bigint, h2 bigint, first bigint, text string, words int, chars int, sketch binary")
_PAIR = "late1 bigint, late2 bigint, early1 bigint, early2 bigint"


def _sketched(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for part in parts:
        texts = part.column(3).to_pylist()
        begin = 0
        while begin < len(texts):  # about CHUNK characters at a time
            end, held = begin, 0
            while end < len(texts) and (end == begin or held + len(texts[end]) <= CHUNK):
                held += len(texts[end])
                end += 1
            words, chars, bins = sketches(texts[begin:end], hashes)
            yield pa.RecordBatch.from_arrays(
                [*part.slice(begin, end - begin).columns, pa.array(words, pa.int32()), pa.array(chars, pa.int32()),
                 pa.array([x.tobytes() for x in bins], pa.binary())],
                names=[*part.schema.names, "words", "chars", "sketch"])
            begin = end


def _candidates(every: bool) -> object:
    """Task: rows (segment, i, j, role, kind, h1, h2, words, chars, sketch, and with ``every`` least) sorted by group and
    order of the line -> pairs of lines worth comparing.  Whole groups at a time."""
    def pairs(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def taken(table: pa.Table) -> pa.RecordBatch:
            c = {n: table.column(n).to_numpy() for n in table.schema.names if n not in ("sketch", "least")}
            new = np.ones(table.num_rows, bool)
            for n in ("segment", "i", "j"):
                new[1:] &= c[n][1:] == c[n][:-1]
            new[1:] = ~new[1:]
            bins = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS + CHAR_BINS)
            least = None
            if every:
                least = np.full((table.num_rows, LEAST), LAST)
                for to, x in zip(least, table.column("least").to_pylist()):
                    to[:len(x)] = x
            late, early = near_sketches(np.cumsum(new), c["role"], c["kind"], c["h1"], c["words"].astype(np.int64),
                                        c["chars"].astype(np.int64), bins, every, c["segment"], least)
            return pa.RecordBatch.from_arrays(
                [pa.array(c[n][at]) for at in (late, early) for n in ("h1", "h2")],
                names=["late1", "late2", "early1", "early2"])

        for part in parts:
            if not part.num_rows:
                continue
            held.append(part)
            if sum(p.num_rows for p in held) < 20_000:
                continue
            table = pa.Table.from_batches(held)
            key = [table.column(n).to_numpy() for n in ("segment", "i", "j")]
            cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0))
            if len(cut):  # the last group may go on
                end = int(cut[-1]) + 1
                yield taken(table.slice(0, end))
                held = table.slice(end).combine_chunks().to_batches()
        if held:
            yield taken(pa.Table.from_batches(held))

    return pairs


def _verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows (late1, late2, late text, early text, others) -> (late1, late2, similar, others)."""
    for part in parts:
        ok = similar_texts(list(zip(part.column(2).to_pylist(), part.column(3).to_pylist())))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(ok), part.column(4)],
                                         names=["late1", "late2", "similar", "others"])


def _counted_grams(chosen) -> object:
    """Task: rows (line, text) -> (gram, n): grams of one in ``COUNTED`` of the lines chosen,
    summed as far as a bounded memory goes."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def count_grams(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(chosen.value, np.uint8)
        gathered = WordEntries()

        def taken() -> pa.RecordBatch:
            gram, line, _ = gathered.whole()
            gram = np.unique(np.stack([line.astype(np.uint64), gram]), axis=1)[1]  # a line counts once
            gram, n = np.unique(gram, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n, pa.int64())], schema=schema)

        for own, text in tuples(parts):
            if own % COUNTED == 0 and _has(bits, own):
                gathered._add(text.encode("utf-8", "surrogatepass"), own, 0)
                if gathered.chars >= 4 * CHUNK:
                    yield taken()
        yield taken()

    return count_grams


def _rare_entries(chosen, late, common) -> object:
    """Task: rows (line, text) -> (entry, line) of the rarest grams of the lines chosen;
    those of late lines are index entries, those of others probes."""
    def enter(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, open_bits = (np.frombuffer(b.value, np.uint8) for b in (chosen, late))
        known, often = common.value
        gathered = WordEntries()

        def taken() -> pa.RecordBatch:
            gram, line = gathered.rarest(known, often)
            mine = {x: INDEX if _has(open_bits, x) else PROBE for x in np.unique(line).tolist()}
            # Mixed again: they are no entries of windows.
            return _entry_batch(_mixed(gram.view(np.uint64)), np.array([mine[x] for x in line.tolist()], np.uint64)
                                | np.uint64(4), line)

        for own, text in tuples(parts):
            if _has(bits, own):
                gathered._add(text.encode("utf-8", "surrogatepass"), own, 0)
                if gathered.chars >= CHUNK:
                    yield taken()
        yield taken()

    return enter


def _by_rare_grams(lines: DataFrame, chosen: DataFrame, late: DataFrame) -> DataFrame:
    """(segment, kind, line): of the lines chosen, those that share one of their rarest
    grams with a late one.  Two similar lines do (by words), however many lines share
    the others, so a frequent phrase costs nothing here.  Any order of grams will do: which
    are frequent is told by counts of a part of the lines, and of the most frequent only."""
    sc = lines.sparkSession.sparkContext
    chosen_bits, late_bits = (sc.broadcast(bitmap_of(x)) for x in (chosen, late))
    texts = lines.select("h1", "text")
    counts = kept(texts.mapInArrow(trimmed(_counted_grams(chosen_bits)), "gram bigint, n bigint").groupBy("gram")
                  .agg(F.sum("n").alias("n")).where(F.col("n") > BLOCK // 4 // COUNTED)
                  .orderBy(F.desc("n"), "gram").limit(COMMON), "line-dedup").toArrow()  # 2 MB at most
    gram, often = counts.column("gram").to_numpy().view(np.uint64), counts.column("n").to_numpy()
    order = np.argsort(gram)
    common = sc.broadcast((gram[order], often[order]))
    live = kept(texts.mapInArrow(trimmed(_rare_entries(chosen_bits, late_bits, common)), "entry bigint, line bigint")
                .repartition(F.shiftright("entry", 2)).sortWithinPartitions("entry")
                .mapInArrow(trimmed(_live), "segment bigint, kind tinyint, line bigint")
                .select("segment", F.lit(WORDS).cast("tinyint").alias("kind"), "line").distinct(), "line-dedup")
    for b in (chosen_bits, late_bits, common):
        b.destroy()
    return live


def _compared(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(late1, late2, similar, others): lines with a candidate, whether one is similar, and
    whether they may have more candidates than these."""
    late, early = (lines.select(F.col("h1").alias(f"{n}1"), F.col("h2").alias(f"{n}2"), F.col("text").alias(f"{n}_text"))
                   for n in ("late", "early"))
    texts = (pairs.groupBy("late1", "late2", "early1", "early2").agg(F.max("others").alias("others"))
             .join(late, ["late1", "late2"]).join(early, ["early1", "early2"]))
    return kept(texts.select("late1", "late2", "late_text", "early_text", "others")
                .mapInArrow(trimmed(_verify), "late1 bigint, late2 bigint, similar boolean, others boolean")
                .groupBy("late1", "late2").agg(F.max("similar").alias("similar"), F.max("others").alias("others")), "line-dedup")


def _in_order(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs of lines (line, other), the later one as late."""
    sides = [lines.select(F.col("h1").alias(n), F.struct("first", "h1", "h2").alias(f"{n}_")) for n in ("line", "other")]
    both = pairs.select("line", "other").join(sides[0], "line").join(sides[1], "other")
    late, early = F.greatest("line_", "other_"), F.least("line_", "other_")
    return both.select(late["h1"].alias("late1"), late["h2"].alias("late2"), early["h1"].alias("early1"),
                       early["h2"].alias("early2"), F.lit(False).alias("others"))


def _own(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    t = col(text).cast("string")
    return docs.select(F.coalesce(col(doc_id).cast("bigint"), F.lit(LAST)).alias("doc"),
                       F.xxhash64(t, F.length(t)).alias("version"), t.alias("text"))


def _blocked(live: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows of ``live`` in blocks: (segment, kind, line, first, until, size, n, wide, block)."""
    # Segments that the same lines share in the same way give the same pairs: one is enough.
    sizes = (live.groupBy("segment").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("line", "kind")).alias("x"),
                                         F.bit_xor(F.xxhash64("kind", "line")).alias("y"))
             .groupBy("n", "x", "y").agg(F.min("segment").alias("s")).select("s", "n"))
    # Of many lines that share words, those of like size: lines within their edits of words
    # are of one class, or of two next to each other.
    of_size = F.when((F.col("n") > BLOCK) & (F.col("kind") == WORDS), F.floor(
        F.log(F.col("words").cast("double")) / -math.log(1 - 1 / WORDS_AN_EDIT))).otherwise(0)
    own = lines.groupBy(F.col("h1").alias("line_"), "words").agg(F.min("first").alias("first"), F.max("first").alias("until"))
    sized = kept(live.join(sizes, F.col("segment") == F.col("s")).join(own, F.col("line") == F.col("line_"))
                 .select("segment", "kind", "line", "first", "until", of_size.cast("int").alias("size")), "line-dedup")
    counts = sized.groupBy("segment", "size").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("rows"))
    wide_segments = (counts.groupBy("segment").agg(F.sum("blocks").alias("all"), F.sum("rows").alias("n"))
                     .where(F.col("all") > 1))
    counts = counts.join(wide_segments, "segment", "left")
    return kept(sized.join(counts, ["segment", "size"]).select(
        "segment", "kind", "line", "first", "until", "size", F.coalesce("n", F.lit(1)).alias("n"), F.col("all").isNotNull().alias("wide"),
        (F.shiftleft(F.col("size").cast("bigint"), 32) + F.pmod(F.xxhash64("line"), F.col("blocks"))).alias("block")),
        "line-dedup")


def _first_lines(rows: DataFrame) -> DataFrame:
    """(segment, i, j, role, kind, line): of each hash and size of several blocks, the first
    lines of its ``FIRST`` earliest blocks, in all blocks of like size."""
    blocks = rows.where("wide").groupBy("segment", "size", "block").agg(F.min(F.struct("first", "line", "kind")).alias("x"))
    leading = (blocks.groupBy(F.col("segment").alias("of"), F.col("size").alias("own"))
               .agg(F.slice(F.sort_array(F.collect_list("x")), 1, FIRST).alias("xs"))
               .select("of", F.explode(F.array(*[F.col("own") + F.lit(d) for d in (-1, 0, 1)])).alias("like"), "xs"))
    return (leading.join(blocks, (F.col("of") == F.col("segment")) & (F.col("like") == F.col("size")))
            .select("segment", "block", F.explode("xs").alias("y"))
            .select("segment", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(1).alias("role"),
                    F.col("y.kind").alias("kind"), F.col("y.line").alias("line")))


def similar_lines(own: DataFrame) -> DataFrame:
    """(h1, h2): every line that has an earlier similar one."""
    spark = own.sparkSession
    live = kept(own.mapInArrow(trimmed(_entries), "bucket int, entries binary")
                .repartition("bucket").sortWithinPartitions("bucket")
                .mapInArrow(trimmed(_live_entries(BLOCK)), "segment bigint, kind tinyint, line bigint, other bigint")
                .groupBy("segment", "line", "other").agg(F.min("kind").alias("kind")), "line-dedup")
    few, live = live.where(F.col("segment") == NONE), live.where(F.col("segment") != NONE).drop("other")
    bitmap = spark.sparkContext.broadcast(bitmap_of(
        live.select("line").unionByName(few.select(F.explode(F.array("line", "other")).alias("line")))))
    lines = kept(own.mapInArrow(trimmed(_found_lines(bitmap)), "h1 bigint, h2 bigint, doc bigint, line string")
                 .groupBy("h1", "h2", "line").agg(F.min("doc").alias("first"))
                 .select("h1", "h2", "first", F.col("line").alias("text")).mapInArrow(trimmed(_sketched), _SKETCHED),
                 "line-dedup")
    bitmap.destroy()
    slim = lines.select("h1", "h2", "first", "words", "chars", "sketch")
    rows = _blocked(live, lines)
    group = ["segment", "i", "j"]

    def pairs(dealt: DataFrame, every: bool) -> DataFrame:
        columns = [*group, "role", "kind", "h1", "h2", slim["first"], "words", "chars", "sketch"]
        whole = dealt.join(slim, F.col("line") == F.col("h1"))
        if every:  # any two lines that share hashes of words meet in all of them, here
            of_words = dealt.where(F.col("kind") == WORDS).groupBy(F.col("line").alias("own")).agg(
                F.slice(F.array_sort(F.collect_set("segment")), 1, LEAST).alias("least"))
            whole = whole.join(of_words, F.col("line") == F.col("own"), "left")
            columns.append(F.when(F.col("kind") == WORDS, F.col("least")).otherwise(F.array().cast("array<bigint>")).alias("least"))
        whole = whole.select(*columns)
        return (whole.repartition(*group).sortWithinPartitions(*group, "first", "h1", "h2", "role").drop("first")
                .mapInArrow(trimmed(_candidates(every)), _PAIR).withColumn("others", F.lit(not every)))

    # First each block by itself, and of the candidates of a line the earliest one.
    # Of the hashes of several blocks two are enough for a line: if it stays open, it meets all of them.
    of_line = (rows.where("wide").groupBy(F.col("line").alias("own"))
               .agg(F.array_distinct(F.array(F.min(F.struct("n", "segment"))["segment"], F.max(F.struct("n", "segment"))["segment"]))
                    .alias("two")).select("own", F.explode("two").alias("of")))
    some = rows.where("wide").join(of_line, (F.col("line") == F.col("own")) & (F.col("segment") == F.col("of")), "left_semi")
    here = rows.where("not wide").unionByName(some).select(
        "segment", F.col("block").alias("i"), F.col("block").alias("j"), F.lit(3).alias("role"), "kind", "line")
    first = _compared(pairs(here.unionByName(_first_lines(rows)), False).unionByName(_in_order(few, lines)), lines)

    def across(rows: DataFrame, late: DataFrame) -> DataFrame:
        """Rows of the segments of ``late`` (line): those lines against the blocks of like size,
        less what stands in no earlier document than any of them."""
        # Those lines are few as a rule: in blocks of their own, they meet few copies of the others.
        late_rows = rows.join(late, "line", "left_semi").select("segment", "kind", "line", "until", "size")
        own_blocks = late_rows.groupBy(F.col("segment").alias("of")).agg(
            F.ceil(F.count("*") / (MET * BLOCK)).alias("blocks"))
        late_rows = kept(late_rows.join(own_blocks, F.col("segment") == F.col("of"))
                         .select("segment", "kind", "line", "until", "size",
                                 F.pmod(F.xxhash64("line"), F.col("blocks")).alias("i")), "line-dedup")
        like = F.explode(F.array(*[F.col("size") + F.lit(d) for d in (-1, 0, 1)]))
        late_blocks = (late_rows.groupBy(F.col("segment").alias("of"), "i", "size").agg(F.max("until").alias("last"))
                       .withColumn("size", like).groupBy("of", "i", "size").agg(F.max("last").alias("last")))
        blocks = rows.groupBy("segment", F.col("block").alias("j"), "size").agg(F.min("first").alias("begin"))
        # A block of late lines has all sizes: a block of one size meets it once, and its lines of like size only.
        met = kept(late_blocks.join(blocks, (F.col("of") == F.col("segment")) & (late_blocks["size"] == blocks["size"])
                                    & (F.col("begin") <= F.col("last")))
                   .select("of", "i", "j", blocks["size"].alias("like"), "last"), "line-dedup")
        early = rows.join(met, (F.col("segment") == F.col("of")) & (F.col("block") == F.col("j"))
                          & (F.col("first") <= F.col("last"))).select(
            "segment", "i", "j", F.lit(1).alias("role"), "kind", "line")
        sides = late_rows.withColumn("size", like)
        return early.unionByName(sides.join(met.withColumnRenamed("i", "block"), (F.col("segment") == F.col("of"))
                                            & (F.col("i") == F.col("block")) & (F.col("size") == F.col("like")))
                                 .select("segment", "i", "j", F.lit(2).alias("role"), "kind", "line"))

    # Then lines without a similar one yet, in segments of several blocks.  Where those are many and
    # words, such a line meets only those that share one of its rarest grams; else all blocks.
    wide = rows.where("wide").select("line").distinct()
    done = first.where("similar").select(F.col("late1").alias("line"), F.col("late2").alias("h2"))
    late = kept(slim.select(F.col("h1").alias("line"), "h2").join(wide, "line", "left_semi")
                .join(done, ["line", "h2"], "left_anti").select("line"), "line-dedup")
    phrase = F.col("wide") & (F.col("n") > MET * BLOCK) & (F.col("kind") == WORDS)
    phrased = rows.where(phrase).select("line").distinct()
    rare = _blocked(_by_rare_grams(lines, phrased, late.join(phrased, "line", "left_semi")), lines)
    rest = rows.where(~phrase)
    second = _compared(pairs(across(rest.where("wide").unionByName(rare), late), False), lines)
    # At last, where the earliest candidate was not similar, all candidates of such a line.
    tried = kept(first.unionByName(second).groupBy("late1", "late2").agg(
        F.max("similar").alias("similar"), F.max("others").alias("others"))
                 .where("others AND NOT similar").select(F.col("late1").alias("line")), "line-dedup")
    third = _compared(pairs(kept(across(rest.unionByName(rare), tried), "line-dedup"), True), lines)
    return (first.unionByName(second).unionByName(third).where("similar")
            .select(F.col("late1").alias("h1"), F.col("late2").alias("h2")).distinct())


def _without(text: str | None, removed: list[int] | None) -> str | None:
    if text is None or not removed:
        return text
    gone = set(removed)
    return "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)


def decisions(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, n_lines, removed, n_similar) of every document with lines: places of
    its lines that go, in order, and how many of them go for a similar line only."""
    own = _own(docs, doc_id, text)
    lines = kept(own.mapInArrow(trimmed(_occurrences), "h1 bigint, h2 bigint, doc bigint, version bigint, place int, "
                                                       "again boolean, n bigint"), "line-dedup")
    once = lines.where("not again")
    first = once.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    similar = settle(similar_lines(own)).select(F.col("h1").alias("s1"), F.col("h2").alias("s2"))
    # Of lines of one document that are not similar to another, only copies within it go.
    first = (first.join(similar, (F.col("h1") == F.col("s1")) & (F.col("h2") == F.col("s2")), "left")
             .select(F.col("h1").alias("f1"), F.col("h2").alias("f2"), "first", "last", F.col("s1").isNotNull().alias("similar"))
             .where("similar OR first < last"))
    gone = (once.join(first, (F.col("h1") == F.col("f1")) & (F.col("h2") == F.col("f2")))
            .select("doc", "version", "place", (F.col("doc") > F.col("first")).alias("equal"), "similar")
            .where("equal OR similar")
            .unionByName(lines.where("again").select("doc", "version", "place", F.lit(True).alias("equal"),
                                                     F.lit(False).alias("similar"))))
    gone = gone.groupBy(F.col("doc").alias("d"), F.col("version").alias("v")).agg(
        F.array_sort(F.collect_set("place")).alias("gone"),
        F.size(F.collect_set(F.when(~F.col("equal"), F.col("place")))).cast("bigint").alias("similar"))
    return (lines.where("n IS NOT NULL").groupBy("doc", "version").agg(F.max("n").alias("n_lines"))
            .join(gone, (F.col("doc") == F.col("d")) & (F.col("version") == F.col("v")), "left")
            .select("doc", "version", "n_lines", F.coalesce("gone", F.array().cast("array<int>")).alias("removed"),
                    F.coalesce("similar", F.lit(0).cast("bigint")).alias("n_similar")))


def line_dedup_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_lines (not blank), n_removed, n_similar (removed for a
    similar, different line) and removed (places of these lines, from 0)."""
    found = decisions(docs, doc_id=doc_id, text=text).select(
        F.col("doc").alias("d"), F.col("version").alias("v"), "n_lines", "removed", "n_similar")
    own = _own(docs, doc_id, text).drop("text")
    zero = F.lit(0).cast("bigint")
    return (own.join(found, (F.col("doc") == F.col("d")) & (F.col("version") == F.col("v")), "left")
            .select(F.nullif("doc", F.lit(LAST)).alias("doc_id"), F.coalesce("n_lines", zero).alias("n_lines"),
                    F.coalesce(F.size("removed").cast("bigint"), zero).alias("n_removed"),
                    F.coalesce("n_similar", zero).alias("n_similar"),
                    F.coalesce("removed", F.array().cast("array<int>")).alias("removed")))


def deduplicated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                 length: str | None = "n_chars") -> DataFrame:
    """``docs`` without the lines that go (``length`` set anew where there is such a
    column), less the documents of which nothing is left."""
    found = decisions(docs, doc_id=doc_id, text=text).where(F.size("removed") > 0).select(
        F.col("doc").alias("d"), F.col("version").alias("v"), "n_lines", "removed")
    whole = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), *[
        c.alias(n) for c, n in zip((F.coalesce(col(doc_id).cast("bigint"), F.lit(LAST)),
                                    F.xxhash64(col(text).cast("string"), F.length(col(text).cast("string")))),
                                   ("doc", "version"))])
    joined = whole.join(found, (F.col("doc") == F.col("d")) & (F.col("version") == F.col("v")), "left")
    joined = joined.where("removed IS NULL OR size(removed) < n_lines")
    old = F.col("row").getField(text).cast("string")
    rebuilt = F.udf(_without, "string", useArrow=True)
    new = F.when(F.col("removed").isNull(), old).otherwise(rebuilt(old, "removed"))
    joined = joined.withColumn("_new", new)
    return joined.select(*[
        F.col("_new").cast(docs.schema[c].dataType).alias(c) if c == text
        else F.when(F.col("removed").isNull(), F.col("row").getField(c))
        .otherwise(F.char_length("_new").cast(docs.schema[c].dataType)).alias(c) if c == length
        else F.col("row").getField(c).alias(c) for c in docs.columns])
