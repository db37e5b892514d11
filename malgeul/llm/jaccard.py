"""Exact Jaccard self-join of word shingles (80 %) by pigeonhole over a partition of the universe.

* Rows with equal sets form a class, named by a 64-bit digest of its set; only classes are joined, and ids of rows
  come in when the components are named.
* The sizes 2^g to 2^(g+1) - 1 form band g.  A pair belongs to the band of its smaller set; a
  set takes part in its own band and, if it is not too large, in the one below.
* Band g cuts the universe of shingle hashes into m(g) segments.  The subset of a set in a segment
  gives a signature (kind F); in the first d(g) segments, each subset without one element gives one
  more (kind D).
* Signatures travel as packed arrays, one for each bucket of keys and about a million signatures; each bucket finds the keys that more than one
  class has, which few are, and only these become rows.  A key that many classes of one such array have goes to its bucket as
  a summary, and its other signatures are dealt to all buckets.
* Sets linked in a band differ in at most H elements, H known from the size.  A set may spend
  t in {-1, 0, 1} on each segment, the sum of t + 1 being H + 1: then a linked set equals it in some
  segment of t = 0, or differs by at most one element in some segment of t = 1.  A segment costs the
  rows that it would be compared with, so rare subsets are taken first.  Segments whose subset
  occurs nowhere else cost nothing, and a set with H + 1 of them is linked with nothing.
* Candidates are verified exactly.  The rows that share a signature are first compared with one of
  them, that whose subsets most sets have, as those of an original among its copies, and components are formed.  Rows that still share signatures with rows of other
  components are cut anew: an element that no other such row has makes a difference to
  all of them, so it leaves the set and lowers H by one.  A pair is then looked up only by the
  one of the two whose segments cost less.
* A set with too few segments to spend H + 1 on is joined by its elements: a linked set has one of any H + 1 of them.

Hashes of shingles have 64 bits; two shingles of one pair of documents are confused
with a probability of about 2^-64 for each pair of shingles, and two classes with one of about n^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from malgeul.llm.common import discard, materialize, require, unused
from malgeul.llm.graph import roots

SHINGLE = 5
#: Similarity in hundredths.
LEAST = 80
#: Sets of fewer elements are linked only with equal sets, as 3 / 4 is under 80 %.
SMALLEST = 4
#: Ids or elements that are broadcast to pick texts; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Signatures of a packed array, and of a bucket, about; classes of one array that share a key from which it counts as common.
PACK, COMMON_KEY = 1_000_000, 64
#: Elements for which a table of sets gets one more file.
FILE_ELEMENTS = 4_000_000
#: Pairs of a key from which rows are compared through a pivot.
MANY_PAIRS = 100
#: Characters of text cut at once.
PART = 1_000_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_LOW = 0xFFFFFFFFFFFFFFFF


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64(salt)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Bytes at word breaks; and powers of an odd number for the places of bytes in a word.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first bytes) of the words of lowered UTF-8, a polynomial of the bytes of each."""
    global _powers
    data = np.frombuffer(raw, np.uint8)
    inside = np.flatnonzero(~_SPACE[data])
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(inside, prepend=-2) != 1)
    size = np.diff(np.append(first, len(inside)))
    if size.max() > len(_powers):
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(size.max()), _BASE)]))
    place = np.arange(len(inside)) - np.repeat(first, size)
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * _powers[place]
    return _mix(np.add.reduceat(values, first), 0), inside[first]


def shingle_sets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct hashes of the word shingles of each text, one after the other.
    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lowered; fewer than five form one shingle."""
    raw = [(t or "").encode().lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw]).astype(np.int64)
    whole, hashes, count, done = b" ".join(raw), [], np.zeros(len(raw), np.int64), 0
    while done < len(whole):  # in pieces that end at a space, so that a very long text takes no more memory than others
        stop = whole.find(b" ", done + PART)
        stop = len(whole) if stop < 0 else stop
        own, begins = word_hashes(whole[done:stop])
        hashes.append(own)
        count += np.bincount(np.searchsorted(ends, begins + done, "right"), minlength=len(raw))
        done = stop
    w = np.concatenate([np.zeros(0, np.uint64), *hashes])
    at = np.concatenate([[0], np.cumsum(count)])
    full = max(0, len(w) - SHINGLE + 1)
    h = np.zeros(len(w), np.uint64)
    for k in range(SHINGLE):
        h[:full] += w[k : full + k] * _ODD[k]
    h[:full] = _mix(h[:full], SHINGLE)
    keep = np.zeros(len(w), bool)
    for i in np.flatnonzero(count):
        a, n = at[i], count[i]
        if n < SHINGLE:
            h[a] = _mix((w[a : a + n] * _ODD[:n]).sum(keepdims=True), n)[0]
            keep[a] = True
        else:
            own = h[a : a + n - SHINGLE + 1]
            own.sort()
            keep[a] = True
            np.not_equal(own[1:], own[:-1], out=keep[a + 1 : a + n - SHINGLE + 1])
    before = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], before[at]


def shingles(text: str | None) -> np.ndarray:
    return shingle_sets([text])[0]


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of runs of rows with about PART characters."""
    first, texts, size = 0, [], 0
    for i, text in enumerate(column):
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size >= PART:
            yield first, texts
            first, texts, size = i + 1, [], 0
    if texts:
        yield first, texts


# ---- bands and segments ----


def bands(n: int) -> list[int]:
    """The bands in which a set of n elements takes part."""
    if n < SMALLEST:
        return []
    g = n.bit_length() - 1
    return [b for b in (g, g - 1) if 1 << b >= SMALLEST and (b == g or LEAST * n <= 100 * ((1 << g) - 1))]


def differing(n: int, g: int) -> int:
    """H: elements in which a set of n elements and one linked with it in band g differ at most."""
    most = n * 100 // LEAST if n.bit_length() - 1 == g else (1 << (g + 1)) - 1
    return (100 - LEAST) * (n + most) // (100 + LEAST)


def layout(g: int) -> tuple[int, int]:
    """Segments of band g, and how many of them also have subsets without one element."""
    units = differing((1 << (g + 1)) - 1, g) + 1
    if g < 6:
        return 2 * units, 2 * units
    m = -(-units * 112 // 100) + 2
    return m, -(-m // 12)


def taken_bands(sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(set, band) for every band in which a set takes part."""
    pairs = [(i, g) for i, n in enumerate(sizes) for g in bands(n)]
    both = np.array(pairs, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


#: slot: band, then one bit for "t = 1 is possible", one for kind D, and the segment.
_BAND, _ABLE, _D = 40, 39, 38


class Signatures:
    """The segments of many sets, each in one band: ``who`` takes part in band ``g``."""

    def __init__(self, h: np.ndarray, offsets: np.ndarray, who: np.ndarray, g: np.ndarray):
        layouts = np.array([layout(b) if 1 << b >= SMALLEST else (1, 0) for b in range(64)], np.int64)
        n = np.diff(offsets)[who]
        self.at = np.concatenate([[0], np.cumsum(n)])
        index = np.repeat(offsets[who] - self.at[:-1], n) + np.arange(self.at[-1])
        self.h, part = h[index], np.repeat(np.arange(len(who)), n)
        self.seg = ((self.h >> np.uint64(32)) * layouts[g, 0].astype(np.uint64)[part] >> np.uint64(32)).astype(np.int64)
        new = np.ones(len(part), bool)
        new[1:] = (self.seg[1:] != self.seg[:-1]) | (part[1:] != part[:-1])
        self.first = np.flatnonzero(new)
        self.size = np.diff(np.append(self.first, len(part)))
        self.part, self.own, self.g = part[self.first], self.seg[self.first], g
        self.able = (self.own < layouts[g, 1][self.part]) & (self.size > 1)

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """For each participation: segments that aren't empty, and those that t = 1 may be spent on."""
        k = len(self.g)
        return np.bincount(self.part, minlength=k), np.bincount(self.part, self.able, k).astype(np.int64)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, slot, participation) of all signatures."""
        if not len(self.first):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        v = _mix(self.h, 0x5851F42D4C957F2D)
        total = np.add.reduceat(v, self.first)
        g = self.g[self.part]
        salt = self.own.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + (g + 1).astype(np.uint64) * np.uint64(0xAEF17502108EF2D9)
        slot = self.own | g << _BAND | self.able.astype(np.int64) << _ABLE
        wide = np.repeat(self.able, self.size)
        cell = np.repeat(np.arange(len(self.first)), self.size)[wide]
        keys = _mix(np.concatenate([total + salt, total[cell] - v[wide] + salt[cell]]), 0x14057B7EF767814F)
        return keys.view(np.int64), np.concatenate([slot, slot[cell] | 1 << _D]), np.concatenate([self.part, self.part[cell]])


def allocate(slots: np.ndarray, n_f: np.ndarray, n_d: np.ndarray, full: int, able: int, h: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Spend H + 1 units on the segments of one set in one band at the least cost.

    The rows are its signatures that other rows share, with the F and D rows of each key; it has ``full``
    segments that aren't empty and ``able`` on which t = 1 may be spent.  Returns for each row whether
    F and whether D rows of its key are looked up, and the cost; None if no unit needs to be paid for."""
    d, seg = (slots >> _D & 1).astype(bool), slots & ((1 << _D) - 1)
    segments, cell = np.unique(seg, return_inverse=True)
    k = len(segments)
    has_f = np.zeros(k, bool)
    has_f[cell[~d]] = True
    can = np.zeros(k, bool)
    can[cell[(slots >> _ABLE & 1).astype(bool)]] = True
    c0 = np.bincount(cell, np.where(d, 0, n_f - 1), k)
    more = np.maximum(c0, np.bincount(cell, np.where(d, n_f, n_d), k))
    need = h + 1 - (full - has_f.sum()) - (able - can.sum())
    if need <= 0:
        return None
    cost = np.concatenate([c0[has_f], more[can]])
    level = np.concatenate([np.zeros(has_f.sum(), int), np.ones(can.sum(), int)])
    which = np.concatenate([np.flatnonzero(has_f), np.flatnonzero(can)])
    order = np.lexsort((which, level, cost))[:need]
    t = np.full(k, -1)
    np.maximum.at(t, which[order], level[order])
    own = t[cell]
    return np.where(d, own == 1, own >= 0), ~d & (own == 1), int(cost[order].sum())


# ---- tables ----


def _digests(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The names of sets."""
    return np.array([xxhash.xxh3_64_intdigest(h[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], np.uint64).view(np.int64)


_BANDS = [f"{c}{i}" for i in (0, 1) for c in ("g", "full", "able", "h")]


def set_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n, lo`` (size and name of the set) and for its one or two bands the units and H."""
    require(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _parts(batch["text"]):
                h, at = shingle_sets(texts)
                sizes = np.diff(at)
                who, g = taken_bands(sizes.tolist())
                full, able = Signatures(h, at, who, g).units()
                second = np.concatenate([[False], who[1:] == who[:-1]]) if len(who) else np.zeros(0, bool)
                columns = []
                for some in (~second, second):
                    none = np.ones(len(texts), bool)
                    none[who[some]] = False
                    for values in (g, full, able, [differing(int(sizes[i]), int(b)) for i, b in zip(who, g, strict=True)]):
                        column = np.zeros(len(texts), np.int64)
                        column[who[some]] = np.array(values, np.int64)[some]
                        columns.append(pa.array(column, mask=none))
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(first, len(texts)), pa.array(sizes), pa.array(_digests(h, at)), *columns], ["doc_id", "n", "lo", *_BANDS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in ("n", "lo", *_BANDS)))


# ---- shared signatures ----

#: Of a key, its bucket and the bits that tell keys of one bucket apart; and the segment bits of a short slot.
_KEY_BITS, _SHORT = 40, 24
_PACKED = "bucket int, sure boolean, keys binary, whose binary, slots binary, sets binary, n_f binary, n_d binary"


def _short_slots(slot: np.ndarray) -> bytes:
    seg = slot & ((1 << _D) - 1)
    if len(seg) and seg.max() >> _SHORT:
        return slot.tobytes()
    return (slot >> _D << _SHORT | seg).astype(np.uint32).tobytes()


def _long_slots(raw: bytes, n: int) -> np.ndarray:
    if len(raw) == 8 * n:
        return np.frombuffer(raw, np.int64)
    slot = np.frombuffer(raw, np.uint32).astype(np.int64)
    return slot >> _SHORT << _D | slot & ((1 << _SHORT) - 1)


def _low_bytes(values: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :n].tobytes()


def _pack(key: np.ndarray, whose: np.ndarray, slot: np.ndarray, los: np.ndarray, buckets: int, classes: int) -> pa.RecordBatch:
    """Signatures of distinct sets ``los`` as a row for each bucket: what the bucket groups, what it must know of common
    keys, and signatures of common keys, dealt to it, that are known to be shared."""
    order = np.argsort(key.view(np.uint64))
    key, whose, slot = key.view(np.uint64)[order], whose[order], slot[order]
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    times = np.diff(np.append(first, len(key)))
    common = np.repeat(times > COMMON_KEY, times)
    is_d = slot >> _D & 1
    n_d = np.repeat(np.add.reduceat(is_d, first), times)
    n_f = np.repeat(times, times) - n_d
    nth = np.arange(len(key)) - np.repeat(first, times)
    rows: list[tuple] = []

    def put(some: np.ndarray, to: np.ndarray, sure: bool, counts: tuple | None) -> None:
        at = np.flatnonzero(some)
        at = at[np.lexsort((slot[at], whose[at], to[at]))]  # by set, so that one bit says whether an entry is of the next one
        cuts = np.flatnonzero(np.concatenate([[True], to[at][1:] != to[at][:-1]])) if len(at) else at
        for a, b in zip(cuts, np.append(cuts[1:], len(at)), strict=True):
            own = at[a:b]
            sets, place = np.unique(whose[own], return_inverse=True)
            keys = _low_bytes(bucket[own] << _KEY_BITS | (key[own] & np.uint64((1 << _KEY_BITS) - 1)).view(np.int64), 8 if sure else _KEY_BITS // 8)
            told = [c[own].astype(np.uint32).tobytes() if counts else b"" for c in counts or (own, own)]
            rows.append((int(to[own[0]]), sure, keys, np.packbits(np.diff(place, prepend=0).astype(bool)).tobytes(), _short_slots(slot[own]), los[sets].tobytes(), *told))

    put(~common, bucket, False, None)
    if common.any():
        whole = nth == 0
        put(common & (nth < 2), bucket, False, (np.where(whole, n_f, 0), np.where(whole, n_d, 0)))
        scale = max(1.0, classes / max(1, len(los)))
        estimate = [np.minimum(n * scale, 2**32 - 1) for n in (n_f, n_d)]
        put(common & (nth >= 2), np.arange(len(key)) % buckets, True, tuple(estimate))
    kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], [c.split()[0] for c in _PACKED.split(", ")])


def signature_arrays(docs: DataFrame, buckets: int, classes: int) -> DataFrame:
    """The signatures of all sets, packed; sets of one array are distinct."""
    assert buckets < 1 << 63 - _KEY_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        seen: dict[int, int] = {}
        size = 0
        for batch in batches:
            for _, texts in _parts(batch["text"]):
                h, at = shingle_sets(texts)
                fresh = []
                for i, lo in enumerate(_digests(h, at).tolist()):
                    if lo not in seen:
                        seen[lo] = len(seen)
                        fresh.append(i)
                place, g = taken_bands(np.diff(at)[fresh].tolist())
                key, slot, part = Signatures(h, at, np.array(fresh, np.int64)[place], g).rows()
                held.append((key, (place + len(seen) - len(fresh))[part], slot))
                size += len(key)
                if size >= PACK or len(seen) > 50_000:
                    yield packed(held, seen)
                    held, seen, size = [], {}, 0
        if size:
            yield packed(held, seen)

    def packed(held: list, seen: dict) -> pa.RecordBatch:
        return _pack(*(np.concatenate(c) for c in zip(*held, strict=True)), np.fromiter(seen, np.int64, len(seen)), buckets, classes)

    return docs.select("text").mapInArrow(run, _PACKED)


def _shared_of(group: pa.Table) -> pa.Table:
    """Of the arrays of one bucket the signatures (key, node, slot) whose key more than one set has, with ``n_f`` and ``n_d``, its
    rows of either kind.  A key without F rows is of no use."""
    kinds: dict[bool, list] = {False: [], True: []}
    for r in group.to_pylist():
        n = len(r["keys"]) // (8 if r["sure"] else _KEY_BITS // 8)
        raw = np.zeros((n, 8), np.uint8)
        raw[:, : len(r["keys"]) // n] = np.frombuffer(r["keys"], np.uint8).reshape(n, -1)
        key = raw.view(np.int64).ravel()
        if not r["sure"]:
            key = key & ((1 << _KEY_BITS) - 1) | r["bucket"] << _KEY_BITS
        slot = _long_slots(r["slots"], n)
        d = slot >> _D & 1
        counts = [np.frombuffer(r[c], np.uint32).astype(np.int64) for c in ("n_f", "n_d")] if r["n_f"] else [1 - d, d]
        kinds[r["sure"]].append((key, np.frombuffer(r["sets"], np.int64)[np.cumsum(np.unpackbits(np.frombuffer(r["whose"], np.uint8), count=n))], slot, *counts, np.full(n, bool(r["n_f"]))))
    none = [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)]
    grouped, sure = ([np.concatenate(c) for c in zip(none, *kinds[k], strict=True)] for k in (False, True))
    if len(grouped[0]):
        order = np.argsort(grouped[0], kind="stable")
        key, lo = grouped[0][order], grouped[1][order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        met = np.minimum.reduceat(lo, first) != np.maximum.reduceat(lo, first)
        order = order[np.repeat(met, np.diff(np.append(first, len(key))))]
        grouped = [c[order] for c in grouped]
    if len(grouped[0]):
        # a set that several arrays have counts once, but for the counts of common keys
        order = np.lexsort((grouped[5], grouped[2], grouped[1], grouped[0]))
        key, lo, slot, f, d, summed = (c[order] for c in grouped)
        again = np.concatenate([[False], (key[1:] == key[:-1]) & (lo[1:] == lo[:-1]) & (slot[1:] == slot[:-1])])
        f, d = (np.where(again & ~summed, 0, x) for x in (f, d))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(np.append(first, len(key)))
        f, d = (np.repeat(np.add.reduceat(x, first), times) for x in (f, d))
        use = ~again & (f > 0)
        grouped = [c[use] for c in (key, lo, slot, f, d)]
    columns = [np.concatenate([a, b]) for a, b in zip(grouped[:5], sure[:5], strict=True)]
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["key", "node", "slot", "n_f", "n_d"])


def shared_signatures(docs: DataFrame, buckets: int, classes: int) -> DataFrame:
    """``key, node, slot, n_f, n_d`` of the signatures that several sets have."""
    return signature_arrays(docs, buckets, classes).groupBy("bucket").applyInArrow(_shared_of, "key long, node long, slot long, n_f long, n_d long")


# ---- allocation ----

_GROUP = ("node", "n", "p", "label", "g", "full", "able", "h")


def _allocated(groups: DataFrame) -> DataFrame:
    """The signatures of the sets that may be linked, ``node, n, p, label, key, d``, with what they look up
    (``find_f``, ``find_d``), the cost of the set, and its ``rank``, the lower the more sets have its subsets.  ``groups`` has a row for
    each set and band with its shared signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 256):
                batch = whole.slice(start, 256)
                flat = batch["rows"].flatten()
                slot, key, n_f, n_d = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                at = np.concatenate([[0], np.cumsum(batch["rows"].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                full, able, h = (batch[c].to_numpy(zero_copy_only=False) for c in ("full", "able", "h"))
                out, index = [], []
                for i in range(len(batch)):
                    own = slice(at[i], at[i + 1])
                    told = allocate(slot[own], n_f[own], n_d[own], int(full[i]), int(able[i]), int(h[i]))
                    if told is not None:
                        d = (slot[own] >> _D & 1).astype(bool)
                        k = len(d)
                        out.append((key[own], d, told[0], told[1], np.full(k, told[2]), np.full(k, -n_f[own][~d].sum())))
                        index.append(np.full(len(told[0]), i))
                if out:
                    own = batch.select(names[:4]).take(pa.array(np.concatenate(index)))
                    yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(np.concatenate(c)) for c in zip(*out, strict=True))], names)

    names = ["node", "n", "p", "label", "key", "d", "find_f", "find_d", "cost", "rank"]
    return groups.select(*_GROUP, "rows").mapInArrow(run, "node long, n long, p long, label long, key long, d boolean, find_f boolean, find_d boolean, cost long, rank long")


def _grouped(rows: DataFrame) -> DataFrame:
    own = F.collect_list(F.struct("slot", "key", "n_f", "n_d")).alias("rows")
    return rows.groupBy("node", "g").agg(*(F.first(c).alias(c) for c in _GROUP if c not in ("node", "g")), own)


# ---- candidates ----

_SIDE = ("node", "n", "p", "label", "cost")


def _may_link(n: Column, m: Column) -> Column:
    return 100 * F.least(n, m) >= LEAST * F.greatest(n, m)


def _pairs_with_one(active: DataFrame, parts: int) -> DataFrame:
    """Distinct pairs (a, b) of rows ``b`` that look a key up and the row ``a`` of least rank of either kind that has it."""
    asks = F.col("find_f") | F.col("find_d")
    of = lambda kind: F.min(F.when(kind, F.struct("rank", "node", "n")))
    least = active.groupBy("key").agg(of(~F.col("d")).alias("f"), of(F.col("d")).alias("e"), F.bool_or(asks).alias("asked"))
    least = materialize(least.filter("asked").drop("asked"), "least", parts=parts)
    both = F.array(F.when(F.col("find_f"), F.col("f")), F.when(F.col("find_d"), F.col("e")))
    met = active.filter(asks).join(least, "key").select("node", "n", F.explode(both).alias("one"))
    met = met.filter((F.col("one.node") != F.col("node")) & _may_link(F.col("n"), F.col("one.n")))
    return met.select(F.col("one.node").alias("a"), F.col("node").alias("b")).distinct()


def _open(rows: DataFrame, parts: int) -> DataFrame:
    """``key, open_f, open_d, work_f, work_d`` of the keys whose rows of a kind and look-ups of these belong to more than one
    component; the work is the pairs that they make."""
    told = []
    for name, kind, find in (("f", ~F.col("d"), F.col("find_f")), ("d", F.col("d"), F.col("find_d"))):
        label, work = F.when(kind | find, F.col("label")), F.count_if(kind) * F.count_if(find)
        told += [F.coalesce((F.min(label) != F.max(label)) & (work > 0), F.lit(False)).alias(f"open_{name}"), work.alias(f"work_{name}")]
    return materialize(rows.groupBy("key").agg(*told).filter("open_f or open_d"), "open", parts=parts)


def _left_open(active: DataFrame, labels: DataFrame, parts: int) -> DataFrame:
    """``node, label`` of the rows that still meet rows of other components."""
    labelled = _relabelled(active, labels)
    keys = _open(labelled, parts)
    part = (F.col("open_f") & (~F.col("d") | F.col("find_f"))) | (F.col("open_d") & (F.col("d") | F.col("find_d")))
    nodes = active.join(keys, "key").filter(part).select("node").distinct()
    return _relabelled(nodes.withColumn("label", F.col("node")), labels)


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.withColumnRenamed("label", "now")
    return rows.join(named, "node", "left").withColumn("label", F.coalesce("now", "node")).drop("now")


def _sets_of(docs: DataFrame, ids: DataFrame, parts: int) -> DataFrame:
    """``node, elements`` of the sets of rows whose doc_id is among ``ids(doc_id)``, made anew from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _parts(batch["text"]):
                h, at = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays([pa.array(_digests(h, at)), pa.ListArray.from_arrays(at.astype(np.int32), pa.array(h.view(np.int64)))], ["node", "elements"])

    ids = materialize(ids.select(F.col("doc_id").alias("wanted")).distinct(), "ids", parts=parts)
    few = ids.count() <= BROADCAST_ROWS
    picked = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    made = materialize(picked.select("text").mapInArrow(run, "node long, elements array<long>"), "elements", parts=parts)
    discard(ids)
    counts = made.agg(F.count("*"), F.count_distinct("node")).first()
    if counts[0] == counts[1]:
        return made
    once = materialize(made.dropDuplicates(["node"]), "elements", parts=parts)  # rows that share an id and a set
    discard(made)
    return once


def _some(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The sets of ``nodes(node)`` alone, so that no others are shuffled, if these are few."""
    nodes = nodes.distinct()
    few = nodes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return sets.join(F.broadcast(nodes), "node", "left_semi") if few else sets


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, n, same, linked``: elements of ``b`` and those that the pairs share."""
    left, right = (_some(sets, pairs.select(F.col(c).alias("node"))) for c in "ab")
    left = left.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = right.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(right, "b").join(left, "a").withColumn("same", F.size(F.array_intersect("x", "y")))
    return both.select("a", "b", F.size("y").alias("n"), "same", (100 * F.col("same") >= LEAST * (F.size("x") + F.size("y") - F.col("same"))).alias("linked"))


def _pivots(compared: DataFrame, parts: int) -> DataFrame:
    """``node, pivot``: rows that share half of their sets with a row that they were compared with form groups, and the row that most
    of a group were compared with is the pivot of all of them."""
    near = compared.filter(2 * F.col("same") >= F.col("n"))
    groups = roots(near.select("a", "b"), parts)
    votes = near.groupBy(F.col("a").alias("node")).agg(F.count("*").alias("votes")).join(groups, "node")
    most = materialize(votes.groupBy("label").agg(F.max_by("node", F.struct("votes", "node")).alias("pivot")), "pivots", parts=parts)
    return groups.join(most, "label").select("node", "pivot")


def _met(left: DataFrame, right: DataFrame, columns: tuple[str, ...], more: Column) -> DataFrame:
    x = left.select("key", "d", *(F.col(c).alias(f"{c}_x") for c in columns))
    y = right.select(F.col("key").alias("key_y"), F.col("d").alias("d_y"), *(F.col(c).alias(f"{c}_y") for c in columns))
    fits = (F.col("key") == F.col("key_y")) & (F.col("d") == F.col("d_y")) & (F.col("label_x") != F.col("label_y"))
    return x.join(y, fits & _may_link(F.col("n_x"), F.col("n_y")) & more)


def _pairs_left(active: DataFrame, told: DataFrame, parts: int) -> DataFrame:
    """The same for sets that were cut anew, each pair looked up by its cheaper row: pairs a < b, still to be verified.

    Where a key makes many pairs, rows told apart by few elements from one ``pivot`` (``told``: node, pivot, delta) are compared by
    the codes of these as they meet.  Codes of two rows never differ in more places than their elements, so no link is lost, and few other
    pairs come out.  Of other rows those come out that their private elements don't keep apart."""
    apart = F.col("p_x") + F.col("p_y")
    delta = F.size("delta_x") + F.size("delta_y") - 2 * F.size(F.array_intersect("delta_x", "delta_y"))
    one = F.coalesce(F.col("pivot_x") == F.col("pivot_y"), F.lit(False))
    within = lambda differ: (100 + LEAST) * differ <= (100 - LEAST) * (F.col("n_x") + F.col("n_y"))
    cheaper = (F.col("cost_x") < F.col("cost_y")) | ((F.col("cost_x") == F.col("cost_y")) & (F.col("node_x") < F.col("node_y")))
    nearest = F.abs(F.size("delta_x") - F.size("delta_y"))
    # one CASE, so that arrays are compared only where sizes leave it open
    close = F.when(~cheaper | ~within(apart), False).when(~one, True).when(~within(apart + nearest), False).otherwise(within(apart + delta))
    keys = _open(active, parts)
    rows = materialize(active.join(keys, "key"), "open", parts=parts)
    kinds = F.array(*(F.struct(F.lit(d).alias("d"), (F.col(f"find_{c}") & F.col(f"open_{c}")).alias("on"), F.col(f"work_{c}").alias("work")) for c, d in (("f", False), ("d", True))))
    looks = rows.select("key", *_SIDE, F.explode(kinds).alias("k")).filter("k.on").select("key", "k.d", *_SIDE, "k.work")
    members = rows.filter((F.col("d") & F.col("open_d")) | (~F.col("d") & F.col("open_f"))).withColumn("work", F.when(F.col("d"), F.col("work_d")).otherwise(F.col("work_f")))
    few, many = F.col("work") <= MANY_PAIRS, F.col("work") > MANY_PAIRS
    plain = _met(looks.filter(few), members.filter(few), _SIDE, cheaper & within(apart)).select("node_x", "node_y")
    wide = lambda x: x.filter(many).join(told, "node", "left")
    hot = _met(wide(looks), wide(members), (*_SIDE, "pivot", "delta"), close).select("node_x", "node_y")
    return plain.unionByName(hot).select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b")).distinct()


def _cut_anew(elements: DataFrame, nodes: DataFrame, pivots: DataFrame, parts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups for ``_allocated``, nodes whose segments don't suffice, ``node, pivot, delta``) of ``nodes(node, label)`` without
    the elements that only one of them has.  ``delta`` holds 16 bits of each element in which a row and its pivot differ, as
    it travels with every open signature."""
    nodes = materialize(nodes, "nodes", parts=parts)
    own = materialize(_some(elements, nodes.select("node")).join(nodes, "node"), "own", parts=parts)
    items = own.select("node", F.explode("elements").alias("item"))
    single = items.groupBy("item").agg(F.count("*").alias("times"), F.min("node").alias("node")).filter("times = 1")
    private = single.groupBy("node").agg(F.collect_list("item").alias("private"))
    empty = F.array().cast("array<long>")
    kept = F.array_except("elements", F.coalesce("private", empty))
    reduced = materialize(own.join(private, "node", "left").select("node", "label", F.size("elements").cast("long").alias("n"), kept.alias("kept")), "kept", parts=parts)
    discard(own)
    of_pivot = elements.select(F.col("node").alias("pivot"), F.col("elements").alias("whole"))
    near = reduced.select("node", "kept").join(pivots, "node").join(of_pivot, "pivot")
    apart = F.concat(F.array_except("kept", "whole"), F.array_except("whole", "kept"))
    code = lambda x: (x.bitwiseAND(0xFFFF) - 0x8000).cast("short")
    told = near.select("node", "pivot", F.array_distinct(F.transform(apart, code)).alias("delta"))
    told = materialize(told, "delta", parts=parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                sets = [np.sort(k.values.to_numpy().view(np.uint64)) for k in part["kept"]]
                sizes = part["n"].to_numpy()
                at = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
                who, g = taken_bands(sizes.tolist())
                private = sizes - np.diff(at)
                h = np.array([differing(int(sizes[w]), int(b)) for w, b in zip(who, g, strict=True)], np.int64) - private[who]
                who, g, h = who[h >= 0], g[h >= 0], h[h >= 0]
                cut = Signatures(np.concatenate([np.zeros(0, np.uint64), *sets]), at, who, g)
                full, able = cut.units()
                key, slot, of = cut.rows()
                thin = full + able <= h
                use = ~thin[of]
                of, key, slot = of[use], key[use], slot[use]
                # a row without key stands for a set whose segments don't suffice
                of = np.concatenate([of, np.flatnonzero(thin)])
                own = part.select(["node", "n", "label"]).take(pa.array(who[of]))
                more = np.zeros(int(thin.sum()), np.int64)
                keys = pa.array(np.concatenate([key, more]), mask=np.concatenate([np.zeros(len(key), bool), np.ones(len(more), bool)]))
                made = [own["node"], own["n"], pa.array(private[who[of]]), own["label"], pa.array(g[of]), pa.array(full[of]), pa.array(able[of]), pa.array(h[of]), keys, pa.array(np.concatenate([slot, more]))]
                yield pa.RecordBatch.from_arrays(made, [*_GROUP, "key", "slot"])

    made = materialize(reduced.mapInArrow(run, ", ".join(f"{c} long" for c in (*_GROUP, "key", "slot"))), "recut", batch=512, parts=parts)
    discard(reduced)
    is_d = F.shiftright("slot", _D).bitwiseAND(1)
    counts = made.filter("key is not null").groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.sum(is_d).alias("n_d"), F.sum(1 - is_d).alias("n_f"))
    counts = materialize(counts.filter("low <> high and n_f > 0").select("key", "n_f", "n_d"), "counts", parts=parts)
    return _grouped(made.join(counts, "key")), made.filter("key is null").select("node").distinct(), told


# ---- sets that segments cannot tell apart ----


def _links_by_elements(docs: DataFrame, classes: DataFrame, nodes: DataFrame, parts: int) -> DataFrame | None:
    """Links (a, b) of the given nodes with all classes.  A set linked with one of n elements lacks at most n / 5 of them, so it has
    one of any n / 5 + 1: these are looked for in all texts."""
    ids = classes.join(nodes, "node").select("doc_id")
    if not nodes.limit(1).count():
        return None
    own = _sets_of(docs, ids, parts).join(nodes, "node")
    needed = F.floor(F.size("elements") * F.lit(100 - LEAST) / 100).cast("int") + 1
    needles = materialize(own.select("node", F.explode(F.slice("elements", F.lit(1), needed)).alias("item")), "needles", parts=parts)
    wanted = needles.select("item").distinct()
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    sought = docs.sparkSession.sparkContext.broadcast(np.sort(wanted.toArrow()["item"].to_numpy()) if few else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in _parts(batch["text"]):
                h, at = shingle_sets(texts)
                items, who = h.view(np.int64), np.repeat(_digests(h, at), np.diff(at))
                if sought.value is not None and len(sought.value):
                    place = np.minimum(np.searchsorted(sought.value, items), len(sought.value) - 1)
                    hit = sought.value[place] == items
                    items, who = items[hit], who[hit]
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(items)], ["other", "item"])

    hits = docs.select("text").mapInArrow(run, "other long, item long")
    met = hits.join(needles, "item").filter("other <> node").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    pairs = materialize(met, "pairs", parts=parts)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = _sets_of(docs, classes.join(ends, "node").select("doc_id"), parts)
    return materialize(_compared(pairs, sets).filter("linked").select("a", "b"), "links", parts=parts)


# ---- the join ----


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(``doc_id, n, lo`` of every row, ``node, label, doc_id`` of every class that isn't empty, files for a table): classes with one
    label are connected, and doc_id is the least of the class."""
    sets = materialize(set_table(docs), "sets")
    total, shuffles = sets.agg(F.sum("n")).first()[0] or 0, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = -(-total // FILE_ELEMENTS)
    of_class = [F.first(c).alias(c) for c in ("n", *_BANDS)]
    classes = materialize(sets.filter("n > 0").groupBy(F.col("lo").alias("node")).agg(F.min("doc_id").alias("doc_id"), *of_class), "classes", parts=parts)
    shared = shared_signatures(docs, max(shuffles, -(-total // PACK)), classes.count())
    of_band = lambda c: F.when(F.col("g") == F.col("g0"), F.col(f"{c}0")).otherwise(F.col(f"{c}1")).alias(c)
    named = shared.join(classes, "node").withColumn("g", F.shiftright("slot", _BAND))
    rows = named.select("node", "n", F.lit(0).cast("long").alias("p"), F.col("node").alias("label"), "g", *map(of_band, ("full", "able", "h")), "key", "slot", "n_f", "n_d")
    active = materialize(_allocated(_grouped(rows)), "active", batch=256, parts=parts)
    ids = active.select("node").distinct().join(classes, "node").select("doc_id")
    elements = _sets_of(docs, ids, parts)
    short = classes.filter("full0 + able0 <= h0 or full1 + able1 <= h1").select("node")
    edges = _links_by_elements(docs, classes, short, parts)
    # all rows of a key against one of them
    first = materialize(_pairs_with_one(active, parts), "pairs", parts=parts)
    compared = materialize(_compared(first, elements), "compared", parts=parts)
    found = compared.filter("linked").select("a", "b")
    labels = roots(found if edges is None else edges.unionByName(found), parts)
    nodes = _left_open(active, labels, parts)
    groups, thin, told = _cut_anew(elements, nodes, _pivots(compared, parts), parts)
    again = materialize(_allocated(groups), "active", batch=256, parts=parts)
    pairs = materialize(_pairs_left(again, told, parts), "pairs", parts=parts)
    stars = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
    edges = stars.unionByName(_compared(pairs, elements).filter("linked").select("a", "b"))
    if (more := _links_by_elements(docs, classes, thin, parts)) is not None:
        edges = edges.unionByName(more)
    labels = roots(edges, parts)
    named = classes.select("node", "doc_id").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id")
    named = materialize(named, "named", parts=parts)
    discard(classes, active, elements, first, compared, told, again, pairs)
    return sets, named, parts


def link(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs(doc_id, text)``.

    Null and empty texts and texts without words have an empty set and are linked with nothing; their component is their own id.  Every
    row is linked by its own text, also where rows share a doc_id or have none; a component is named by its least doc_id that isn't null, and null
    if it has none.  Ids are of any type that Spark can order.  Repeated rows all stay, other columns are ignored, and an
    empty table gives no rows.
    """
    sets, named, parts = _classes(docs)
    least = materialize(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "least", parts=parts)
    names = materialize(named.join(least, "label").select(F.col("node").alias("lo"), "component_id"), "names", parts=parts)
    discard(named, least)
    out = sets.select("doc_id", "n", "lo").join(names, "lo", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _with_sets(docs: DataFrame, size: str, name: str) -> DataFrame:
    """``docs`` with the size and name of the set of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _parts(batch["text"]):
                h, at = shingle_sets(texts)
                own = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.diff(at)), pa.array(_digests(h, at))], [*own.schema.names, size, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(size, LongType()), StructField(name, LongType())]))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of least doc_id, null last; of such rows with one
    doc_id those of the least set, and of these the one whose text sorts first.  Rows with an empty set all stay.  Columns
    of any name and type come back as they were; an empty table gives no rows."""
    sets, named, parts = _classes(docs)
    rows = sets.select("doc_id", "n", F.col("lo").alias("node"))
    whole = rows.join(named.select("node", "label"), "node")
    best = whole.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("best"))
    best = materialize(best.select("best.doc_id", "best.node"), "best", parts=parts)
    ids = rows.groupBy("doc_id").agg(F.count("*").alias("times"), F.max((F.col("n") == 0).cast("int")).alias("bare"))
    ids = ids.join(best.select(F.col("doc_id").alias("own"), F.lit(1).alias("one")).distinct(), F.col("doc_id").eqNullSafe(F.col("own")), "left")
    ids = materialize(ids.select("doc_id", ((F.col("times") > 1) | F.col("doc_id").isNull()).alias("odd"), (F.col("one").isNotNull() | (F.col("bare") == 1)).alias("kept")), "ids", parts=parts)
    discard(named)
    wanted, size, name = (unused(docs, c) for c in ("wanted", "set_size", "set_name"))

    def rows_of(some: DataFrame, how: str, few: bool) -> DataFrame:
        own = some.select(F.col("doc_id").alias(wanted))
        return docs.join(F.broadcast(own) if few else own, F.col("doc_id").eqNullSafe(F.col(wanted)), how)

    is_odd, is_kept = F.col("odd"), F.col("kept")
    dropped, kept, odd = ids.agg(F.count_if(is_odd | ~is_kept), F.count_if(~is_odd & is_kept), F.count_if(is_odd)).first()
    if dropped <= BROADCAST_ROWS:
        out = rows_of(ids.filter("odd or not kept"), "left_anti", True)
    else:
        out = rows_of(ids.filter("not odd and kept"), "left_semi", kept <= BROADCAST_ROWS)
    if not odd:
        return out
    named_rows = _with_sets(rows_of(ids.filter("odd and kept"), "left_semi", odd <= BROADCAST_ROWS), size, name)
    first = best.select(F.col("doc_id").alias(wanted), F.col("node").alias(unused(docs, "node")))
    same = F.col("doc_id").eqNullSafe(F.col(wanted)) & (F.col(name) == F.col(unused(docs, "node")))
    copies = named_rows.filter(F.col(size) > 0).join(first, same, "left_semi")
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    order = F.struct(F.col("text"), F.xxhash64(*plain))
    one = copies.groupBy("doc_id", name).agg(F.min_by(F.struct(*docs.columns), order).alias(size)).select(f"{size}.*")
    return out.unionByName(one.select(*docs.columns)).unionByName(named_rows.filter(F.col(size) == 0).select(*docs.columns))
