"""SentencePiece encoding and decoding by suffix-array matching."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.suffixes import suffix_array
from tessera.llm.words import held

#: Words and parts of words that a Python worker remembers; slots of its table of piece pairs; bytes matched at once.
MEMORY, SLOTS, AT_ONCE = 500_000, 1 << 21, 1 << 20
BLANK = "▁"
_HEAD, _BITS = 7, 9
_UNIT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_TAIL = re.compile(r"[!-/:-@\[-`{-~]+$")


def merged(text: str, score: dict[str, float]) -> tuple[list[str], tuple[str, str] | None]:
    """Pieces that byte-pair merging leaves (best score first, then leftmost), and the two parts merged last."""
    parts, last = list(text), None
    while len(parts) > 1:
        best = max(((score.get(parts[i] + parts[i + 1], -np.inf), -i) for i in range(len(parts) - 1)))
        if best[0] == -np.inf:
            break
        i = -best[1]
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts, last


class Pieces:
    """A model's pieces, how each is merged, and which two can stand side by side."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        names = [model.id_to_piece(i) for i in every]
        special = [model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i) for i in every]
        self.byte_id = {int(names[i][3:5], 16): i for i in every if model.is_byte(i)}
        score = {names[i]: model.get_score(i) for i in every if not special[i]}
        ids = {names[i]: i for i in every if not special[i]}
        self.unknown = len(names)
        n = len(names) + 1
        self.score = np.full(n, np.inf)
        self.left, self.right = np.arange(n), np.arange(n)
        reached = []
        for name, i in ids.items():
            if len(name) == 1:
                reached.append(name)
                continue
            got, last = merged(name, score)
            if len(got) == 1 and last[0] in ids and last[1] in ids:
                reached.append(name)
                self.score[i], self.left[i], self.right[i] = score[name], ids[last[0]], ids[last[1]]
        known = set(reached)
        joins = [(ids[name[:k]] * n + ids[name[k:]], score[name]) for name in ids if len(name) > 1 for k in range(1, len(name)) if name[:k] in known and name[k:] in known]
        joins.sort()
        self.join_key, self.join_score = np.array([j[0] for j in joins], np.int64), np.array([j[1] for j in joins])
        self.n = n
        self.inner = {name[k : k + 2] for name in ids for k in range(len(name) - 1)}
        self.singles = {name for name in ids if len(name) == 1}
        order = sorted(reached, key=lambda x: x.encode())
        self.names = [x.encode() for x in order]
        self.ids = np.array([ids[x] for x in order])
        self.sizes = np.array([len(x) for x in self.names])
        self.longest = int(self.sizes.max())
        levels = -(-self.longest // _HEAD)
        self.chunk = np.zeros((levels, len(order)), np.uint64)
        for j, name in enumerate(self.names):
            for k, b in enumerate(name):
                self.chunk[k // _HEAD, j] |= np.uint64((b + 1) << (_BITS * (_HEAD - 1 - k % _HEAD)))
        self.pair_key = np.full(SLOTS, -1, np.int64)
        self.pair_ok = np.zeros(SLOTS, bool)
        text = [x.replace(BLANK, " ").encode() for x in names]
        for b, i in self.byte_id.items():
            text[i] = bytes([b])
        for i in every:
            if model.is_control(i):
                text[i] = b""
            elif model.is_unknown(i):
                text[i] = " ⁇ ".encode()
        self.text = text

    def _compatible(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether merging leaves a border between two pieces: no merge across it would come before those that
        made the pieces. Goes back in time, undoing the latest merge next to the border each turn."""
        ok = np.ones(len(one), bool)
        x, y = one.copy(), two.copy()
        low1, low2 = np.full(len(one), -np.inf), np.full(len(one), -np.inf)
        rows = np.arange(len(one))
        while len(rows):
            a, b = x[rows], y[rows]
            key = a * self.n + b
            at = np.minimum(np.searchsorted(self.join_key, key), len(self.join_key) - 1)
            across = np.where(self.join_key[at] == key, self.join_score[at], -np.inf)
            bad = (across > low1[rows]) & (across >= low2[rows]) & (across > -np.inf)
            ok[rows[bad]] = False
            first = self.score[a] < self.score[b]
            rest = ~bad & np.isfinite(np.minimum(self.score[a], self.score[b]))
            go = rest & first
            low1[rows[go]], x[rows[go]] = self.score[a[go]], self.right[a[go]]
            go = rest & ~first
            low2[rows[go]], y[rows[go]] = self.score[b[go]], self.left[b[go]]
            rows = rows[rest]
        return ok

    def compatible(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        key = one * self.n + two
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        hit = self.pair_key[slot] == key
        out = self.pair_ok[slot]
        if not hit.all():
            miss = np.flatnonzero(~hit)
            fresh, back = np.unique(key[miss], return_inverse=True)
            got = self._compatible(fresh // self.n, fresh % self.n)
            out[miss] = got[back]
            self.pair_key[slot[miss]], self.pair_ok[slot[miss]] = key[miss], out[miss]
        return out

    def edges(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and number (in byte order) of every occurrence of every piece in the texts."""
        order, _ = suffix_array(text, ends, self.longest)
        n = len(text)
        place = np.arange(n)
        key = np.zeros(n + 1, np.uint64)
        for k in range(_HEAD):
            shifted = np.zeros(n, np.uint64)
            shifted[: n - k] = text[k:].astype(np.uint64) + np.uint64(1)
            shifted[place + k >= ends] = 0
            key[:n] |= shifted << np.uint64(_BITS * (_HEAD - 1 - k))
        lo, hi = np.zeros(len(self.names), np.int64), np.full(len(self.names), n)
        for level in range(len(self.chunk)):
            rows = np.flatnonzero((self.sizes > level * _HEAD) & (lo < hi))
            if not len(rows):
                break
            size = np.minimum(self.sizes[rows] - level * _HEAD, _HEAD)
            drop = (_BITS * (_HEAD - size)).astype(np.uint64)
            want = self.chunk[level, rows] >> drop

            def seen(at: np.ndarray, drop: np.ndarray, level: int = level) -> np.ndarray:
                spot = order[at]
                ahead = spot + level * _HEAD
                return np.where(ahead < ends[spot], key[np.minimum(ahead, n)], np.uint64(0)) >> drop

            for upper in (False, True):
                a, b = lo[rows].copy(), hi[rows].copy()
                while (live := np.flatnonzero(a < b)).size:
                    middle = (a[live] + b[live]) >> 1
                    got = seen(middle, drop[live])
                    less = got <= want[live] if upper else got < want[live]
                    a[live] = np.where(less, middle + 1, a[live])
                    b[live] = np.where(less, b[live], middle)
                if upper:
                    hi[rows] = a
                else:
                    low = a
            lo[rows] = low
        count = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(count)), count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return order[np.repeat(lo, count) + inner], piece

    def encode_units(self, units: list[str]) -> list[list[int]]:
        """Ids of each unit: all edges by position, then the one path whose neighbours can stand side by side."""
        raw = [u.encode() for u in units]
        sizes = np.array([len(r) for r in raw])
        text = np.frombuffer(b"".join(raw), np.uint8)
        stop = np.cumsum(sizes)
        begin = stop - sizes
        ends = np.repeat(stop, sizes)
        starts, piece = self.edges(text, ends)
        past, ids = starts + self.sizes[piece], self.ids[piece]
        # A character that no piece has stands alone.
        heads = np.flatnonzero((text & 0xC0) != 0x80)
        tails = np.append(heads[1:], len(text))
        single = np.zeros(len(text), bool)
        single[starts[past == tails[np.searchsorted(heads, starts)]]] = True
        lone = ~single[heads]
        starts, past = np.concatenate([starts, heads[lone]]), np.concatenate([past, tails[lone]])
        ids = np.concatenate([ids, np.full(lone.sum(), self.unknown)])
        base = np.repeat(begin, sizes)
        turn = past - base[starts]
        order = np.argsort(turn, kind="stable")
        starts, past, ids, turn = starts[order], past[order], ids[order], turn[order]
        last, back = np.full(len(text) + 1, -1, np.int64), np.full(len(text) + 1, -1, np.int64)
        first = starts == base[starts]
        # ``last[p]`` is the piece before the border p, of the text up to p; a border between units is two places.
        at = 0
        bounds = np.flatnonzero(np.diff(turn)) + 1
        for stop_at in [*bounds.tolist(), len(turn)]:
            s, e, t, f = starts[at:stop_at], past[at:stop_at], ids[at:stop_at], first[at:stop_at]
            before = np.where(f, -1, last[s - 1])
            good = f | (before >= 0)
            test = np.flatnonzero(~f & good)
            if len(test):
                good[test] = self.compatible(before[test], t[test])
            last[e[good] - 1], back[e[good] - 1] = t[good], s[good]
            at = stop_at
        out = []
        last, back = last.tolist(), back.tolist()
        for u, (a, b) in zip(raw, zip(begin.tolist(), stop.tolist(), strict=True), strict=True):
            path = []
            while b > a:
                s = back[b - 1]
                if last[b - 1] == self.unknown:
                    path += [self.byte_id[x] for x in reversed(u[s - a : b - a])]
                else:
                    path.append(last[b - 1])
                b = s
            out.append(path[::-1])
        return out


class Encoder(dict):
    """Packed ids of remembered words."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.parts: dict[str, bytes] = {}

    def _split(self, unit: str) -> list[str]:
        """A unit cut before its closing signs, where no piece holds the two characters at the cut."""
        tail = _TAIL.search(unit)
        if tail and 0 < tail.start() and unit[tail.start() - 1 : tail.start() + 1] not in self.pieces.inner:
            return [unit[: tail.start()], unit[tail.start() :]]
        return [unit]

    def learn(self, units: set[str]) -> None:
        if len(self) > MEMORY:
            self.clear()
        if len(self.parts) > MEMORY:
            self.parts.clear()
        new = [u for u in units if u not in self]
        split = [self._split(u) for u in new]
        fresh = sorted({p for ps in split for p in ps if p not in self.parts})
        some, size = [], 0
        for k, part in enumerate(fresh):
            some.append(part)
            size += len(part)
            if size > AT_ONCE or k == len(fresh) - 1:
                for name, ids in zip(some, self.pieces.encode_units(some), strict=True):
                    self.parts[name] = np.array(ids, "<u4").tobytes()
                some, size = [], 0
        for unit, ps in zip(new, split, strict=True):
            self[unit] = b"".join([self.parts[p] for p in ps])

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = []
        for text in texts:
            if not text:
                cut.append([])
            elif BLANK in text or "  " in text or text[0] == " " or text[-1] == " ":
                cut.append(_UNIT.findall(BLANK + text.replace(" ", BLANK)))
            else:
                cut.append([BLANK + w for w in text.split(" ")])
        self.learn({u for c in cut for u in c})
        return [b"".join(map(self.__getitem__, c)) for c in cut]

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        raw = b"".join(map(self.pieces.text.__getitem__, numbers))
        if numbers and raw[:1] == b" " and self.pieces.text[numbers[0]][:1] == b" " and numbers[0] != 0:
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _encoder(path: str) -> Encoder:
    return held(f"pieces {path}", lambda: Encoder(Pieces(path)))


def _model(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col array<int>``, the model's ids of the whole text.

    Words are looked up; new ones of a batch are joined to one text, whose suffix array finds all occurrences of
    every piece by binary search. These edges, sorted by where they end, are relaxed: a border is reached by the one
    piece that byte-pair merging would leave before it, which is the one compatible with the piece that reaches its
    own start. Characters without a piece become bytes.

    Null text gives null, empty text no ids; a column of that name gives way. Rows are on their own.
    """
    path = _model(model)

    @F.pandas_udf("array<int>")
    def run(texts):
        import pandas as pd

        encoder = _encoder(path)
        out = []
        for at in range(0, len(texts), 1024):
            some = texts.iloc[at : at + 1024].tolist()
            got = encoder.encode([t or "" for t in some])
            out += [None if t is None else np.frombuffer(g, "<i4") for t, g in zip(some, got, strict=True)]
        return pd.Series(out, dtype=object)

    return docs.withColumn(ids_col, run(F.col(text_col)))


def decode(docs: DataFrame, model: str | None = None, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with ``text_col``, the text of ``ids_col``: blanks for their sign, the first one dropped, bytes put
    together (those that are no UTF-8 give U+FFFD). Null gives null; a column of that name gives way."""
    path = _model(model)

    @F.pandas_udf("string")
    def run(column):
        import pandas as pd

        encoder = _encoder(path)
        return pd.Series([None if ids is None else encoder.decode(np.asarray(ids, "<u4").tobytes()) for ids in column], dtype=object)

    return docs.withColumn(text_col, run(F.col(ids_col)))


def digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, decoded_sha256)``: encoding and decoding in one pass, without moving ids."""
    path = _model(model)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string())])

    def run(batches):
        encoder = _encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                got = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(g) // 4 for g in got], pa.int64()), pa.array([zlib.crc32(g) for g in got], pa.int64()),
                     pa.array([hashlib.sha256(encoder.decode(g).encode()).hexdigest() for g in got])], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
