"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut where no piece can cross (before a blank that follows a non-blank: no
piece of the vocabulary has a blank after another character), and each distinct word is kept once.
The words' concatenation is indexed by a suffix array, sorted to the depth of the longest piece;
every piece of the vocabulary is found in it by binary search, which gives all its occurrences. A word
longer than what is indexed at once is indexed in windows.
These edges are sorted by position and relaxed from left to right: an edge is taken if the piece
before it and its own piece are neighbours that byte-pair merging leaves apart. The encoding of every
prefix has exactly one such last piece, so the result is that of the merges by score, not an
approximation. Runs of blanks, whose pieces merge last, are looked up by length.

The vocabulary is a SentencePiece BPE model with byte fallback, identity normalisation and a dummy
prefix; others are refused. Encoding and decoding restore every text but for the character U+2581,
which SentencePiece takes for a blank. Null and empty texts have no pieces and decode to "". In
decoding, null ids and ids that the vocabulary lacks stand for nothing, and a null list for null.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from .util import map_batches, spread, utf8

BLANK = "▁"
#: Stands between words in the index; no text in UTF-8 holds it.
END = "\ud800"
#: Bytes of text that are read ahead and encoded together; characters of distinct words that are indexed
#: at once; characters of words whose encodings are remembered.
AHEAD = 6 << 20
INDEXED = 600_000
CACHED = 6_000_000


class Vocabulary:
    """The pieces of a model, and which neighbours byte-pair merging leaves apart."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.size = n
        self.text = [sp.id_to_piece(i) for i in range(n)]
        byte = [i for i in range(n) if sp.is_byte(i)]
        if len(byte) != 256 or sp.normalize("Ａ  b") != f"{BLANK}Ａ{BLANK}{BLANK}b":
            raise ValueError("only models with byte fallback and identity normalisation are supported")
        self.byte_ids = np.array(byte)
        skip = set(byte) | {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)}
        self.pieces = [i for i in range(n) if i not in skip]
        if any(BLANK in self.text[i].lstrip(BLANK) for i in self.pieces):
            raise ValueError("a piece has a blank after another character")
        self.blanks = {len(self.text[i]): i for i in self.pieces if not self.text[i].strip(BLANK)}
        self.blank_rank = {k: (-sp.get_score(i), i) for k, i in self.blanks.items()}
        # Ranks: the order in which merges are tried.
        words = [i for i in self.pieces if self.text[i].strip(BLANK) or self.text[i] == BLANK]
        self.words = sorted(words, key=lambda i: (-sp.get_score(i), i))
        self.rank_of = {self.text[i]: r for r, i in enumerate(self.words)}
        self.id_of = np.array(self.words)
        self.single = {self.text[i]: self.rank_of[self.text[i]] for i in words if len(self.text[i]) == 1}
        self.longest = max(len(self.text[i]) for i in words)
        self.alphabet = np.array(sorted(map(ord, self.single)))
        self.matrix = np.zeros((len(words), self.longest), np.int64)  # characters of each piece by rank, filled up with 0
        for r, i in enumerate(self.words):
            self.matrix[r, : len(self.text[i])] = [ord(c) for c in self.text[i]]
        self.size_of = (self.matrix > 0).sum(1)
        self._split()
        raw = [b"" if i in skip and i not in set(byte) else self.text[i].replace(BLANK, " ").encode() for i in range(n)]
        for b, i in enumerate(byte):
            raw[i] = bytes([b])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        self.cache_key = np.full(1 << 21, -1, np.int64)
        self.cache_value = np.zeros(1 << 21, bool)

    def _split(self) -> None:
        """For each rank the two pieces whose merge makes it, and all pairs that merge.

        A single character is its own left and right part. Pieces that merging does not reach are
        marked: they never occur.
        """
        text = [self.text[i] for i in self.words]
        n = len(text)
        self.left, self.right, self.reached = np.arange(n), np.arange(n), np.zeros(n, bool)
        pairs = {}
        for r, t in enumerate(text):
            for k in range(1, len(t)):
                a, b = self.rank_of.get(t[:k]), self.rank_of.get(t[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        for r, t in enumerate(text):
            parts = merged([self.single.get(c, -1) for c in t], pairs, stop=r)
            if len(parts) == 1 or len(t) == 1:
                self.reached[r] = True
            elif len(parts) == 2 and pairs.get(parts[0] << 32 | parts[1]) == r:
                self.left[r], self.right[r], self.reached[r] = parts[0], parts[1], True
        keys = np.array(sorted(pairs), np.int64)
        self.pair_key, self.pair_rank = keys, np.array([pairs[k] for k in keys.tolist()], np.int64)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b; a very large number where they do not merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], 1 << 40)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging leaves pieces a and b (ranks) next to each other as they are."""
        key = a << 20 | b
        slot = (key * 0x9E3779B1 >> 7) & (len(self.cache_key) - 1)
        known = self.cache_key[slot] == key
        out = self.cache_value[slot]
        if not known.all():
            missing = np.unique(key[~known])
            fresh = self._apart(missing >> 20, missing & (1 << 20) - 1)
            out[~known] = fresh[np.searchsorted(missing, key[~known])]
            at = (missing * 0x9E3779B1 >> 7) & (len(self.cache_key) - 1)
            self.cache_key[at], self.cache_value[at] = missing, fresh
        return out

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undoes the merges of both sides, the latest first, and looks for an earlier one across the boundary.

        ``bound`` is the rank of the merge undone last, or one more if it was on the right side: a
        merge across the boundary with a rank below it would have come before (of equal ranks, the
        one further left comes first).
        """
        out = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y, bound = a.copy(), b.copy(), np.full(len(a), 1 << 39)
        while len(live):
            across = self._pair(x, y) < bound
            out[live[across]] = False
            x_single, y_single = self.left[x] == x, self.left[y] == y
            stay = ~across & ~(x_single & y_single)
            undo_x = ~x_single & ((x > y) | y_single)
            bound = np.where(undo_x, x, y + 1)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
            live, x, y, bound = live[stay], x[stay], y[stay], bound[stay]
        return out

    @lru_cache(4096)
    def run(self, n: int) -> tuple[int, ...]:
        """Ids of a run of n blanks."""
        if n > 256 and 16 in self.blanks:  # what is far to the left merges to the longest pieces
            k = (n - 128) // 16
            return (self.blanks[16],) * k + self.run(n - 16 * k)
        parts = [1] * n
        while True:
            best = min(((self.blank_rank[parts[i] + parts[i + 1]][0], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in self.blanks), default=None)
            if best is None:
                return tuple(self.blanks[p] for p in parts)
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]


def merged(parts: list[int], pairs: dict[int, int], stop: int) -> list[int]:
    """Byte-pair merging by rank, of equal ranks the leftmost first; only merges of a rank below ``stop``."""
    while len(parts) > 1:
        best = min((pairs.get(parts[i] << 32 | parts[i + 1], stop), i) for i in range(len(parts) - 1))
        if best[0] >= stop:
            break
        parts[best[1] : best[1] + 2] = [best[0]]
    return parts


def suffix_array(codes: np.ndarray, depth: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """(positions in the order of their suffixes to ``depth`` characters, the sorted suffixes as bytes).

    Codes are from 1; 0 separates words, and a suffix ends there.
    """
    width = 2 if wide else 1
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(depth, codes.dtype)]).astype(">u2" if wide else np.uint8)
    size = -(-depth * width // 8) * 8
    keys = np.zeros((n, size), np.uint8)
    alive = np.ones(n, bool)
    for k in range(depth):
        c = padded[k : k + n]
        alive = alive & (c != 0)
        keys[:, k * width : (k + 1) * width] = np.where(alive, c, 0).astype(padded.dtype).view(np.uint8).reshape(n, width)
    order = np.lexsort(keys.view(">u8").astype(np.uint64).T[::-1])
    return order, np.ascontiguousarray(keys[order]).view(f"S{size}").ravel()


def _as_keys(spelled: np.ndarray, width: int, wide: bool) -> np.ndarray:
    out = np.zeros((len(spelled), width), np.uint8)
    out[:, : spelled.shape[1] * (1 + wide)] = spelled.astype(">u2" if wide else np.uint8).view(np.uint8).reshape(len(spelled), -1)
    return out.view(f"S{width}").ravel()


def matches(v: Vocabulary, cp: np.ndarray) -> tuple[np.ndarray, ...]:
    """All occurrences of pieces in characters cp: (start, rank, length); and for each character whether it is END, and whether it has no piece."""
    number = np.zeros(0x110000, np.int32)
    number[cp] = 1
    present = np.flatnonzero(number)
    known = np.isin(present, v.alphabet)
    number[present] = np.where(known, np.cumsum(known), known.sum() + 1)
    number[ord(END)] = 0
    codes, wide = number[cp], known.sum() > 250
    order, keys = suffix_array(codes, v.longest, wide)

    # Every piece made of characters that occur: where its suffixes begin and end.
    there = np.zeros(0x110000, bool)
    there[present[known]] = there[0] = True
    whole = np.flatnonzero(there[v.matrix].all(1) & v.reached)
    if not len(whole):
        return whole, whole, whole, codes == 0, codes > known.sum()
    padding = v.matrix[whole] == 0
    spelled = np.where(padding, 0, number[v.matrix[whole]])
    width = keys.dtype.itemsize
    begin = np.searchsorted(keys, _as_keys(spelled, width, wide), "left")
    end = np.searchsorted(keys, _as_keys(np.where(padding, 65535 if wide else 255, spelled), width, wide), "right")
    found = end - begin
    return order[spread(begin, found)], np.repeat(whole, found), np.repeat((~padding).sum(1), found), codes == 0, codes > known.sum()


def encode_words(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets by word) of words that hold no blank, each encoded with one blank before it."""
    joined = (END + BLANK).join(["", *words]) + END
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)[1:]  # no word begins before the first blank
    n = len(cp)
    start, rank, length, ended, strange = matches(v, cp)

    # Cuts: the places that no edge crosses. Words and characters without a piece are bounded by them.
    crossed = np.cumsum(np.bincount(start + 1, minlength=n + 2) - np.bincount(start + length, minlength=n + 2))[: n + 1]
    cut = crossed == 0
    place = np.arange(n + 1)
    segment = np.maximum.accumulate(np.where(cut, place, 0))
    offset = start - segment[start]
    by = np.argsort(offset.astype(np.uint16) if not len(offset) or offset.max() < 65536 else offset, kind="stable")
    start, rank, length, offset = start[by], rank[by], length[by], offset[by]

    # Relaxation: last[p] is the last piece of the encoding of what lies between the cut and p.
    last = np.full(n + 1, -1, np.int64)
    steps = np.searchsorted(offset, np.arange((int(offset.max()) if len(offset) else -1) + 2))
    first = slice(steps[0], steps[1]) if len(steps) > 1 else slice(0, 0)
    last[start[first] + length[first]] = rank[first]
    # two pieces may begin at a cut and end at different places: each is the whole encoding of its prefix
    for k in range(1, len(steps) - 1):
        s = slice(steps[k], steps[k + 1])
        before = last[start[s]]
        e = np.flatnonzero(before >= 0)
        if len(e):
            r = rank[s][e]
            ok = v.apart(before[e], r)
            e = e[ok]
            last[start[s][e] + length[s][e]] = r[ok]

    # Back from each segment's end; characters without a piece become bytes.
    ends = np.flatnonzero(cut & (segment[np.maximum(place - 1, 0)] < place) & (place > 0))
    at, token = [], []
    live = ends[last[ends] >= 0]
    floor = segment[live - 1]
    while len(live):
        r = last[live]
        live = live - v.size_of[r]
        at.append(live)
        token.append(v.id_of[r])
        more = live > floor
        live, floor = live[more], floor[more]
    odd = np.flatnonzero(strange)
    if len(odd):
        data = [chr(c).encode() for c in cp[odd].tolist()]
        lens = np.array([len(d) for d in data])
        at.append(np.repeat(odd, lens))
        token.append(v.byte_ids[np.frombuffer(b"".join(data), np.uint8)])
    at, token = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, token))
    by = np.argsort(at, kind="stable")
    bounds = np.concatenate([[0], np.flatnonzero(ended) + 1])
    return token[by], np.searchsorted(at[by], bounds)


def encode_long(v: Vocabulary, word: str, window: int) -> np.ndarray:
    """Ids of one word that is too long to be indexed at once, encoded with one blank before it.

    The text is indexed window by window, each with as many characters of the next as a piece may
    reach into it, and relaxed character by character. A segment's pieces are settled where no edge
    crosses, so only its own last pieces are held.
    """
    cp = np.frombuffer((BLANK + word).encode("utf-32-le", "surrogatepass"), np.uint32)
    out, apart = array("i"), {}
    base, reach = 0, 0  # where the segment begins; how far edges reach from what is behind
    last = array("i", [-1])  # by place in the segment

    def settle(p: int) -> None:
        back = []
        while p > base:
            r = last[p - base]
            back.append(int(v.id_of[r]))
            p -= int(v.size_of[r])
        out.extend(reversed(back))

    for at in range(0, len(cp), window):
        start, rank, length, _, strange = matches(v, cp[at : at + window + v.longest - 1])
        own = start < window
        start, rank, length = start[own], rank[own], length[own]
        by = np.argsort(start, kind="stable")
        cut = np.searchsorted(start[by], np.arange(min(window, len(cp) - at) + 1)).tolist()
        ranks, ends = rank[by].tolist(), (start[by] + length[by] + at).tolist()
        for i in range(len(cut) - 1):
            p = at + i
            if reach <= p:
                settle(p)
                base, last = p, array("i", [-1])
                if strange[i]:
                    out.extend(int(v.byte_ids[x]) for x in chr(cp[p]).encode())
                    base = reach = p + 1
                    continue
            if cut[i] == cut[i + 1]:
                continue
            before = last[p - base] if p > base and p - base < len(last) else -1
            if p > base and before < 0:
                reach = max(reach, *ends[cut[i] : cut[i + 1]])
                continue
            for e in range(cut[i], cut[i + 1]):
                r, z = ranks[e], ends[e]
                reach = max(reach, z)
                if p > base:
                    ok = apart.get(before << 20 | r)
                    if ok is None:
                        ok = apart[before << 20 | r] = bool(v.apart(np.array([before]), np.array([r]))[0])
                    if not ok:
                        continue
                if len(last) <= z - base:
                    last.extend([-1] * (z - base + 1 - len(last)))
                last[z - base] = r
    settle(len(cp))
    return np.frombuffer(out, np.int32).astype(np.int64)


class Encoder:
    """Encodes texts; remembers the words it has seen, up to CACHED characters, then begins anew."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.off, self.held = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text)."""
        if self.held > CACHED:
            self._forget()
        number, before = self.number, len(self.number)
        units: list[int] = []
        counts = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                begun = len(units)
                parts = t.replace(BLANK, " ").split(" ")
                if "" in parts:
                    parts = _with_runs(parts)
                for w in parts:
                    units.append(number.setdefault(w, len(number)))
                counts[k] = len(units) - begun
        if len(number) > before:
            names = list(islice(number, before, None))
            ids, off = _encode_units(self.v, names)
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.off = np.concatenate([self.off, off[1:] + self.off[-1]])
            self.held += sum(map(len, names))
        unit = np.array(units, np.int64)
        length = self.off[unit + 1] - self.off[unit]
        total = np.concatenate([[0], np.cumsum(length)])
        return self.ids[spread(self.off[unit], length)], total[np.concatenate([[0], np.cumsum(counts)])]


def _with_runs(parts: list[str]) -> list[str]:
    """Words with the blanks before them beyond the first, which stands before every word; blanks alone at the end."""
    out, more = [], 0
    for w in parts[:-1]:
        if w:
            out.append(" " * more + w)
            more = 0
        else:
            more += 1
    out.append(" " * more + parts[-1] if parts[-1] else " " * (more + 1))
    return out


def _encode_units(v: Vocabulary, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words, words with more than one blank before them, and runs of blanks alone."""
    bare = [w.lstrip(" ") for w in names]
    distinct = list(dict.fromkeys(w for w in bare if w))
    ids, off = [], [np.zeros(1, np.int64)]
    i = base = 0
    while i < len(distinct):  # as many words at a time as are indexed together
        j, size = i, 0
        while j < len(distinct) and (j == i or size + len(distinct[j]) + 2 <= INDEXED):
            size += len(distinct[j]) + 2
            j += 1
            if size > INDEXED:
                break
        if len(distinct[i]) > INDEXED:
            got = encode_long(v, distinct[i], INDEXED)
            o = np.array([0, len(got)])
        else:
            got, o = encode_words(v, distinct[i:j])
        ids.append(got)
        off.append(o[1:] + base)
        base += len(got)
        i = j
    flat, at = np.concatenate(ids) if ids else np.zeros(0, np.int64), np.concatenate(off)
    if all(w == b for w, b in zip(names, bare)):
        return flat, at
    number = {w: k for k, w in enumerate(distinct)}
    out, sizes = [], np.zeros(len(names), np.int64)
    alone = v.blanks[1]
    for k, (w, b) in enumerate(zip(names, bare)):
        extra = len(w) - len(b)
        own = flat[at[number[b]] : at[number[b] + 1]] if b else flat[:0]
        if extra and len(own) and own[0] == alone:  # nothing merged with the word's blank: it belongs to the run
            own, extra = own[1:], extra + 1
        got = np.concatenate([np.array(v.run(extra), np.int64), own]) if extra else own
        out.append(got)
        sizes[k] = len(got)
    return np.concatenate(out), np.concatenate([[0], np.cumsum(sizes)])


def decode_ids(v: Vocabulary, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets by text): the pieces' bytes without the dummy prefix's blank."""
    length = np.diff(v.raw_at)[ids]
    ends = np.concatenate([[0], np.cumsum(length)])
    raw = v.raw[spread(v.raw_at[ids], length)]
    at = ends[off]
    some = np.flatnonzero((np.diff(at) > 0))
    drop = at[some][raw[at[some]] == 32]
    keep = np.ones(len(raw), bool)
    keep[drop] = False
    return raw[keep], at - np.searchsorted(drop, at)


@lru_cache(2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def encode(df: DataFrame, model_file: str, keep: list[str], text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``keep`` plus n_pieces, ids, and restored: whether decoding the ids gives the text again.

    With ``decoded`` also the decoded text. The driver reads ``model_file`` and sends it to the
    workers.
    """
    shared = df.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())

    def group(encoder: Encoder, arrays: list[pa.Array]) -> Iterator[list[pa.Array]]:
        joined = pa.concat_arrays([a.fill_null("") for a in arrays])
        raw, off = utf8(joined)
        ids, at = encoder(joined.to_pylist())
        back, back_at = decode_ids(encoder.v, ids, at)
        same = np.diff(off) == np.diff(back_at)
        if len(back) == len(raw) and same.all() and (back == raw).all():
            pass
        else:
            a, b = raw.tobytes(), back.tobytes()
            same = np.array([a[off[i] : off[i + 1]] == b[back_at[i] : back_at[i + 1]] for i in range(len(same))], bool)
        i = 0
        for x in arrays:
            j = i + len(x)
            o = at[i : j + 1]
            out = [pa.array(np.diff(o)), pa.ListArray.from_arrays(pa.array((o - o[0]).astype(np.int32)), pa.array(ids[o[0] : o[-1]].astype(np.int32))), pa.array(same[i:j])]
            if decoded:
                d = back_at[i : j + 1]
                out.append(pa.StringArray.from_buffers(len(x), pa.py_buffer((d - d[0]).astype(np.int32).tobytes()), pa.py_buffer(back[d[0] : d[-1]].tobytes())))
            yield out
            i = j

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        encoder = Encoder(vocabulary(shared.value))
        waiting, size = [], 0
        for (texts,) in batches:
            waiting.append(texts)
            size += texts.nbytes
            if size >= AHEAD:
                yield from group(encoder, waiting)
                waiting, size = [], 0
        if waiting:
            yield from group(encoder, waiting)

    return map_batches(df, keep, [text_col], "n_pieces long, ids array<int>, restored boolean" + ", decoded string" * decoded, run)


def decode(df: DataFrame, model_file: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``keep`` plus decoded, the text of the ids."""
    shared = df.sparkSession.sparkContext.broadcast(Path(model_file).read_bytes())

    def run(batches: Iterator[list[pa.Array]]) -> Iterator[list[pa.Array]]:
        v = vocabulary(shared.value)
        for (lists,) in batches:
            ids = pc.cast(lists.flatten(), pa.int64())
            fine = pc.fill_null(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, v.size)), False).to_numpy(zero_copy_only=False)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(fine)])[np.concatenate([[0], np.cumsum(size)])]
            raw, off = decode_ids(v, pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)[fine], at)
            data, none = raw.tobytes(), lists.is_null().to_pylist()
            yield [pa.array([None if x else data[a:b].decode("utf-8", "replace") for x, a, b in zip(none, off[:-1], off[1:])], pa.string())]

    return map_batches(df, keep, [ids_col], "decoded string", run)
