"""Merge-type subword encoding with seeded merge dropout, and its decoding.

The vocabulary is a SentencePiece model of the merge type (a piece's score is
its rank; byte pieces cover what no piece has).  A space becomes ``▁``, one
``▁`` goes before the text, and merges never cross from another character to
a ``▁`` (checked on the vocabulary when it is opened), so the text falls into
chunks (``▁`` and what follows) that are segmented on their own.

Segmentation of a chunk keeps an agenda of adjacent pairs that form a piece,
best score first, then leftmost.  Each pair taken from the agenda is skipped
for good with probability ``dropout``; else it is merged and its new
neighbours join the agenda.  Every occurrence of a chunk has draws of its own,
from a keyed hash of (seed, doc_id, text, place of the chunk in the text), so
equal words get different segmentations, and the same seed gives the same ids
again.  The draws are the gaps between skips (geometric): one where none of
the pairs taken is skipped.

A segmentation depends only on the chunk and on which pairs were skipped (the
first, second, ... taken), so a worker keeps what it has met by both: the plain
segmentation with how many pairs it takes, and below it, by the number of the
next skip, the segmentation with that skip, and so on.  An occurrence goes
down until its next skip lies beyond the pairs taken.  Segmentations that a
worker has not met are made side by side in numpy: in each round every chunk
takes one pair from its agenda.  Chunks longer than ``WIDE`` characters go one
at a time by a heap, each occurrence anew.

Decoding joins the pieces' bytes and drops the first space: it returns the
very text that was encoded.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to an empty text; a ``▁`` of the text itself is written in byte
pieces, so it comes back; control strings in a text are ordinary characters;
a null doc_id is a key like any other; repeated rows get the same ids; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept, mix, released, text_columns
from .tokens import text_groups

DROPOUT, SEED = 0.1, 17
WIDE = 64
#: segmentations that a worker keeps
MEMO_CHUNKS = 800_000
MARK = "▁"
_NONE = np.int32(1 << 30)
#: a skip that never comes
_NEVER = 1 << 40
_ODD = 0x9E3779B97F4A7C15
_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")
_OPEN: dict[tuple, Codec] = kept("dropout")


def _table(left: np.ndarray, right: np.ndarray, rank: np.ndarray):
    """Pairs of ids as an open-addressed table: keys, ranks and the longest search."""
    size = 1 << int(4 * len(left) + 1).bit_length()
    keys, ranks = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32)
    code = (left.astype(np.int64) << 32) | right
    todo, step = np.arange(len(code)), 0
    slot = (mix(code.view(np.uint64)) & np.uint64(size - 1)).astype(np.int64)
    while len(todo):
        at = (slot[todo] + step) & (size - 1)
        free = keys[at] < 0
        first = np.zeros(len(todo), dtype=bool)
        first[np.unique(at, return_index=True)[1]] = True
        take = free & first
        keys[at[take]], ranks[at[take]] = code[todo[take]], rank[todo[take]]
        todo, step = todo[~take], step + 1
    return keys, ranks, step


def _distinct(parts: list[str]) -> tuple[list[str], np.ndarray]:
    """The distinct parts as they first come up, and the number of each part among them."""
    code = pa.array(parts, pa.string()).dictionary_encode().indices.to_numpy()
    # numbers are given in order, so a part is new where its number is the largest so far
    first = np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1))
    return list(map(parts.__getitem__, first.tolist())), code


def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Runs of 16-bit ids that end at ``ends``, as bytes."""
    raw, at = ids.tobytes(), [0, *(2 * ends).tolist()]
    return [raw[a:b] for a, b in zip(at, at[1:], strict=False)]


class Codec:
    """A vocabulary with encode and decode for batches of texts.

    ``variants`` is not read: the number of segmentations has no bound.
    """

    def __init__(self, path: str, dropout: float, seed: int, variants: int | None = None):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
        byte = [sp.is_byte(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i] and not byte[i]}
        if "\n" in "".join(self.ids):
            raise ValueError("pieces of this vocabulary hold new lines")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("pieces of this vocabulary cross from other characters to a space mark")
        if n >= 1 << 16 or sum(byte) != 256:
            raise ValueError("a vocabulary under 65,536 pieces with all byte pieces is needed")
        self.byte_ids = [0] * 256
        raw = []
        for i, p in enumerate(pieces):
            if byte[i]:
                self.byte_ids[int(p[3:5], 16)] = i
                raw.append(bytes([int(p[3:5], 16)]))
            else:
                raw.append(b"" if special[i] else p.replace(MARK, " ").encode())
        # decoding: all pieces' bytes in one array
        self.size = np.array([len(r) for r in raw], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        # merges: every way to part a piece in two; characters that are no piece get ids above
        score = [sp.get_score(i) for i in range(n)]
        left, right, rank, merged = [], [], [], []
        order = {i: k for k, i in enumerate(sorted(self.ids.values(), key=lambda i: -score[i]))}
        self.rank = [order.get(i, 0) for i in range(n)]
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                a, b = self.ids.get(p[:k]), self.ids.get(p[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(order[i]), merged.append(i)
        self.pairs = {(a, b): (r, m) for a, b, r, m in zip(left, right, rank, merged, strict=True)}
        self.table = _table(*(np.array(x, dtype=np.int64) for x in (left, right, rank)))
        #: the piece of each rank
        self.piece = np.array(sorted(order, key=order.__getitem__), dtype=np.int32)
        self.n = n
        # a character's id; one without a piece is n + its code point
        self.of = np.arange(n, n + 0x110000, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of[ord(p)] = i
        # log of a draw times this is the number of pairs until the next skip
        self.scale = None if dropout <= 0 else 0.0 if dropout >= 1 else 1 / np.log1p(-dropout)
        self.key = np.uint64(xxhash.xxh64_intdigest(str(seed).encode()))
        _distinct([])  # Arrow loads pandas with its first array
        self._forget()

    # ---------------------------------------------------------------- segmentation

    def _symbols(self, chunks: list[str]) -> np.ndarray:
        """Ids of the characters of all chunks, one row each, closed by -1."""
        size = np.array([len(c) for c in chunks], dtype=np.int64)
        flat = self.of[np.frombuffer("".join(chunks).encode("utf-32-le"), dtype="<u4")]
        out = np.full((len(chunks), int(size.max()) + 1), -1, dtype=np.int32)
        row = np.repeat(np.arange(len(chunks)), size)
        out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        return out

    def _out(self, symbols) -> bytes:
        """Ids as little-endian 16-bit bytes, with byte pieces for what has none."""
        ids = []
        for s in symbols:
            if s < self.n:
                ids.append(s)
            else:
                ids += [self.byte_ids[b] for b in chr(s - self.n).encode()]
        return np.array(ids, dtype="<u2").tobytes()

    def _base(self, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Key of the draws for each occurrence."""
        return mix(mix(keys + self.key) + places * np.uint64(_ODD))

    def _gap(self, base: np.ndarray, nth: int) -> np.ndarray:
        """Pairs that are not skipped before the ``nth`` skip (after the one before)."""
        if self.scale is None:
            return np.full(len(base), _NEVER)
        u = ((mix(base + np.uint64((nth + 1) * _ODD % (1 << 64))) >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53
        return (np.log(u) * self.scale).astype(np.int64)

    def segment_one(self, chunk: str, key: int, place: int = 0) -> bytes:
        """One occurrence of a chunk by a heap."""
        sym = self._symbols([chunk])[0, :-1].tolist()
        base = self._base(np.array([key], np.uint64), np.array([place], np.uint64))
        taken, skips, due = 0, 0, int(self._gap(base, 0)[0])
        n = len(sym)
        size, nxt, prev = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list = []

        def offer(i):
            j = nxt[i]
            if i >= 0 and j < n and (m := self.pairs.get((sym[i], sym[j]))):
                heapq.heappush(agenda, (m[0], i, size[i], size[j], m[1]))

        for i in range(n - 1):
            offer(i)
        while agenda:
            _, i, a, b, merged = heapq.heappop(agenda)
            j = nxt[i] if size[i] == a else n
            if j >= n or size[j] != b or size[i] == 0:
                continue  # one of the two has been merged since
            taken += 1
            if taken > due:
                skips += 1
                due = taken + int(self._gap(base, skips)[0])
                continue
            sym[i], size[i], size[j], nxt[i] = merged, a + b, 0, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            if prev[i] >= 0:
                offer(prev[i])
            offer(i)
        return self._out([s for s, k in zip(sym, size, strict=True) if k])

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks (or none) of pairs."""
        keys, ranks, steps = self.table
        code = (left.astype(np.int64) << 32) | right
        slot = (mix(code.view(np.uint64)) & np.uint64(len(keys) - 1)).astype(np.int64)
        found = keys[slot]
        rank = np.where(found == code, ranks[slot], _NONE)
        left_over = np.flatnonzero((found != code) & (found >= 0))
        for step in range(1, steps):
            if not len(left_over):
                break
            at = (slot[left_over] + step) & (len(keys) - 1)
            found = keys[at]
            hit = found == code[left_over]
            rank[left_over[hit]] = ranks[at[hit]]
            left_over = left_over[~hit & (found >= 0)]
        return rank

    def _merge(self, chunks: list[str], skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Many short chunks, side by side: in each round each takes one pair from its agenda.

        ``skips``: of each chunk, the rounds that skip, ascending, closed by
        -1.  Returns the ids, how many each chunk has and the numbers of pairs taken.
        """
        count = len(chunks)
        rows = self._symbols(chunks)
        width = rows.shape[1]
        # places count through all rows; each row ends with a -1, which also parts it from the next one
        sym, end = rows.ravel(), rows.size
        taken = np.zeros(count, dtype=np.int16)
        nxt, prev = np.arange(1, end + 1), np.arange(-1, end - 1)
        rank = np.full(end, _NONE, dtype=np.int32)
        ranks = rank.reshape(count, width)
        pair = np.flatnonzero(sym[1:] >= 0)
        pair = pair[sym[pair] >= 0]
        rank[pair] = self._look(sym[pair], sym[pair + 1])
        skips, depth = skips.ravel(), skips.shape[1]
        turn = np.arange(count) * depth
        live, nth = np.arange(count), 0
        while len(live):
            at = live * width + np.argmin(ranks if len(live) == count else ranks[live], axis=1)
            go = rank[at] < _NONE
            if not go.all():
                taken[live[~go]] = nth
                live, at = live[go], at[go]
                if not len(live):
                    break
            skip = skips[turn[live]] == nth
            nth += 1
            if skip.any():
                turn[live[skip]] += 1
                rank[at[skip]] = _NONE
                at = at[~skip]
            j = nxt[at]
            k = nxt[j]
            whole = self.piece[rank[at]]
            sym[at], sym[j], rank[j], nxt[at], prev[k] = whole, -1, _NONE, k, at
            # the pairs with the new symbol
            p = prev[at]
            left, right, both = np.concatenate((whole, sym[p])), np.concatenate((sym[k], whole)), np.concatenate((at, p))
            rank[both] = _NONE
            has = (left | right) >= 0
            rank[both[has]] = self._look(left[has], right[has])
        # symbols in order; characters without a piece are rare
        keep = sym >= 0
        flat, held = sym[keep], keep.reshape(count, width).sum(axis=1)
        ids, odd = flat.astype("<u2"), np.flatnonzero(flat >= self.n)
        if len(odd):
            of = np.searchsorted(np.cumsum(held), odd, side="right")
            written = [np.frombuffer(self._out([s]), dtype="<u2") for s in flat[odd].tolist()]
            cut = np.split(ids, np.stack((odd, odd + 1), axis=1).ravel())
            cut[1::2] = written
            ids = np.concatenate(cut)
            np.add.at(held, of, [len(x) - 1 for x in written])
        return ids, held, taken

    def _forget(self):
        """Nothing is kept; the empty chunk is node 0."""
        self.plain: dict[str, int] = {"": 0}
        #: node below a node (times 256, plus the number of the skipped pair)
        self.below: dict[int, int] = {}
        #: ids of all nodes, one after the other (16-bit bytes), and where each node's end
        self.ids, self.ids_of = bytearray(), array("q", [0])
        self.taken = np.zeros(1 << 12, dtype=np.int16)
        self.parent, self.skip = np.full(1 << 12, -1, dtype=np.int32), np.zeros(1 << 12, dtype=np.int16)
        self.depth = np.zeros(1 << 12, dtype=np.int16)

    def _skips(self, nodes: np.ndarray) -> np.ndarray:
        """The skips of each node, one row each, closed by -1."""
        depth = self.depth[nodes]
        out = np.full((len(nodes), int(depth.max()) + 1), -1, dtype=np.int16)
        rows = np.flatnonzero(depth)
        while len(rows):
            depth[rows] -= 1
            out[rows, depth[rows]] = self.skip[nodes[rows]]
            nodes[rows] = self.parent[nodes[rows]]
            rows = rows[depth[rows] > 0]
        return out

    def _learn(self, chunks: list[str], parents: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Nodes of chunks, each with the skips of its parent (-1: none) and one more."""
        first, n = len(self.ids_of), len(chunks)
        if first + n > len(self.taken):
            more = max(first + n - len(self.taken), len(self.taken))
            self.taken, self.parent, self.skip, self.depth = (
                np.concatenate((x, np.full(more, fill, x.dtype))) for x, fill in ((self.taken, 0), (self.parent, -1), (self.skip, 0), (self.depth, 0))
            )
        # chunks of like length together, about 60,000 characters at a time
        size = np.fromiter(map(len, chunks), np.int64, n)
        order = np.argsort(size, kind="stable")
        own = slice(first, first + n)
        self.parent[own], self.skip[own] = parents[order], skip[order]
        self.depth[own] = np.where(parents[order] < 0, 0, self.depth[parents[order]] + 1)
        chunks, size, at = [chunks[k] for k in order.tolist()], size[order], 0
        while at < n:
            end = min(n, at + max(1, 60_000 // (int(size[at]) + 4)))
            ids, held, taken = self._merge(chunks[at:end], self._skips(np.arange(first + at, first + end)))
            self.ids_of.frombytes((np.cumsum(held) + self.ids_of[-1]).astype(np.int64).tobytes())
            self.ids += ids.tobytes()
            self.taken[first + at : first + end] = taken
            at = end
        out = np.empty(n, dtype=np.int64)
        out[order] = np.arange(first, first + n)
        return out

    def _occurrences(self, chunks: list[str], base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all occurrences of short chunks under their draws, one after the other, and how many each has."""
        if len(self.ids_of) > MEMO_CHUNKS:
            self._forget()
        names, code = _distinct(chunks)
        found = np.fromiter(map(self.plain.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(found < 0)
        if len(new):
            missing, none = [names[k] for k in new.tolist()], np.full(len(new), -1)
            found[new] = self._learn(missing, none, none)
            self.plain.update(zip(missing, found[new].tolist(), strict=True))
        node = found[code]
        due, nth = self._gap(base, 0), 0
        live = np.flatnonzero(due < self.taken[node])
        due = due[live]
        while len(live):
            keys = node[live] * 256 + due
            below = np.fromiter(map(self.below.get, keys.tolist(), repeat(-1)), np.int64, len(keys))
            new = np.flatnonzero(below < 0)
            if len(new):
                missing, at, of = np.unique(keys[new], return_index=True, return_inverse=True)
                nodes = self._learn([names[k] for k in code[live[new[at]]].tolist()], missing >> 8, missing & 255)
                self.below.update(zip(missing.tolist(), nodes.tolist(), strict=True))
                below[new] = nodes[of]
            node[live] = below
            nth += 1
            due = due + 1 + self._gap(base[live], nth)
            go = due < self.taken[below]
            live, due = live[go], due[go]
        ends = np.frombuffer(self.ids_of, dtype=np.int64)
        first = ends[np.maximum(node - 1, 0)]
        size = ends[node] - first
        total = np.cumsum(size)
        at = np.repeat(first - (total - size), size) + np.arange(int(total[-1]) if len(total) else 0)
        return np.frombuffer(self.ids, dtype="<u2")[at], size

    def segment(self, chunks: list[str], key: int, places: np.ndarray | None = None) -> list[bytes]:
        """Short chunks that occur at ``places`` (0) of a text with a key."""
        places = np.zeros(len(chunks), np.uint64) if places is None else places
        ids, size = self._occurrences(chunks, self._base(np.full(len(chunks), key, np.uint64), places))
        return _cut(ids, np.cumsum(size))

    # -------------------------------------------------------------------- texts

    def chunks(self, text: str) -> list[str]:
        """A text without marks of its own as chunks, each with its mark.

        A new line is no piece, so no merge meets it: it is a chunk itself
        (and some empty chunks may come up beside it).
        """
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " ":
            return _PART.findall(MARK + text.replace(" ", MARK))
        return (MARK + text.replace(" ", " " + MARK).replace("\n", " \n ")).split(" ")

    def encode(self, texts: list[str], keys: list[int]) -> list[bytes]:
        """Ids of each text (16-bit bytes); ``keys``: what the draws of each text come from."""
        parts, plans = [], []
        for t in texts:
            if MARK in t:  # the text's own marks part it; each is written in byte pieces
                own: list = []
                for k, piece in enumerate(t.split(MARK)):
                    if k:
                        own.append(None)
                    got = self.chunks(piece)
                    # only the text's start has a mark that the text has not
                    own += [got[0][1:], *got[1:]] if k and got else got
                    if not k and not got:
                        own.append(MARK)
                plans.append(own)
            else:
                plans.append(None)
            parts.append(self.chunks(t) if plans[-1] is None else [c for c in plans[-1] if c is not None])
        size = np.array([len(own) for own in parts], dtype=np.int64)
        ends = np.cumsum(size)
        flat = [c for own in parts for c in own]
        place = np.arange(len(flat), dtype=np.int64) - np.repeat(ends - size, size)
        text = np.repeat(np.array(keys, dtype=np.uint64), size)
        long = [k for k, n in enumerate(map(len, flat)) if n > WIDE]
        apart = {k: self.segment_one(flat[k], int(text[k]), int(place[k])) for k in long}
        for k in long:
            flat[k] = ""
        ids, held = self._occurrences(flat, self._base(text, place.astype(np.uint64)))
        stop = np.concatenate(([0], np.cumsum(held)))
        out = _cut(ids, stop[ends])
        # texts with long chunks or marks of their own are put together chunk by chunk
        mark = np.array([self.byte_ids[b] for b in MARK.encode()], dtype="<u2").tobytes()
        parted = {t for t, plan in enumerate(plans) if plan is not None} | set(np.searchsorted(ends, long, side="right").tolist())
        for t in parted:
            a, b = int(ends[t] - size[t]), int(ends[t])
            got = _cut(ids[stop[a] : stop[b]], stop[a + 1 : b + 1] - stop[a])
            it = iter([apart.get(k, x) for k, x in enumerate(got, a)])
            out[t] = b"".join(it if plans[t] is None else [mark if c is None else next(it) for c in plans[t]])
        return out

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 texts of runs of ids that end at ``ends``."""
        size = self.size[ids]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        data = self.raw[np.repeat(self.begin[ids] - (stop - size), size) + np.arange(total)].tobytes()
        at = np.concatenate(([0], stop))[np.concatenate(([0], ends))].tolist()
        return [data[a + 1 : b] for a, b in zip(at, at[1:], strict=False)]


def codec(path: str, dropout: float, seed: int) -> Codec:
    key = (path, dropout, seed)
    if key not in _OPEN:
        _OPEN[key] = Codec(path, dropout, seed)
    return _OPEN[key]


def text_keys(ids: list, texts: list[str]) -> list[int]:
    """Keys of rows by doc_id and text."""
    return [xxhash.xxh64_intdigest(t.encode(), xxhash.xxh64_intdigest(str(i).encode())) for i, t in zip(ids, texts, strict=True)]


def _encode(path: str, dropout: float, seed: int):
    def run(batches):
        c = codec(path, dropout, seed)
        for batch in batches:
            doc_ids, done = batch.column("doc_id"), 0
            for texts in text_groups(batch.column("text").to_pylist()):
                n = len(texts)
                own = doc_ids.slice(done, n)
                coded = c.encode(texts, text_keys(own.to_pylist(), texts))
                size = np.array([len(x) // 2 for x in coded], dtype=np.int64)
                ids = np.frombuffer(b"".join(coded), dtype="<u2").astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([own, pa.array(size), lists], names=["doc_id", "n_tokens", "ids"])
                done += n

    return run


def encode(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_tokens, ids."""
    return text_columns(docs).mapInArrow(_encode(model_path, dropout, seed), "doc_id bigint, n_tokens bigint, ids array<int>")


def _decode(path: str):
    def run(batches):
        c = codec(path, 0.0, 0)
        for batch in batches:
            lists = batch.column("ids")
            off = lists.offsets.to_numpy().astype(np.int64)
            ids = lists.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]]
            texts = c.decode(ids, off[1:] - off[0])
            rest = [batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(texts, pa.binary()).cast(pa.string())], names=[*batch.schema.names, "decoded"])

    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` (with a column ``ids``) and the text its ids decode to, as ``decoded``."""
    return encoded.mapInArrow(_decode(model_path), T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())]))


def _round_trip(path: str, dropout: float, seed: int):
    def run(batches):
        c = codec(path, dropout, seed)
        for batch in batches:
            ids, done = batch.column("doc_id"), 0
            for texts in text_groups(batch.column("text").to_pylist()):
                n = len(texts)
                own = ids.slice(done, n)
                coded = c.encode(texts, text_keys(own.to_pylist(), texts))
                size = np.array([len(x) // 2 for x in coded], dtype=np.int64)
                flat = np.frombuffer(b"".join(coded), dtype="<u2")
                back = c.decode(flat.astype(np.int64), np.cumsum(size))
                yield pa.RecordBatch.from_arrays(
                    [
                        own, pa.array(size), pa.array([hashlib.sha256(x).hexdigest() for x in coded]), pa.array([hashlib.sha256(x).hexdigest() for x in back]),
                        pa.array([t.encode() == x for t, x in zip(texts, back, strict=True)]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "lossless"],
                )
                done += n

    return run


def round_trip(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (ids as little-endian 16-bit), decoded_sha256, lossless."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, lossless boolean"
    return text_columns(docs).mapInArrow(_round_trip(model_path, dropout, seed), schema)


def _encoded(path: str, dropout: float, seed: int):
    """Encodes and decodes in one pass, so a task has one worker with one codec."""
    run = _encode(path, dropout, seed)

    def both(batches):
        for batch in run(batches):
            lists = batch.column("ids")
            off = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values.to_numpy()[off[0] : off[-1]].astype(np.int64)
            back = codec(path, dropout, seed).decode(flat, off[1:] - off[0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([hashlib.sha256(x).hexdigest() for x in back])], names=[*batch.schema.names, "decoded_sha256"])

    return both


def encoded_report(docs: DataFrame, model_path: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Per document the ids and the digest of the text they decode to: doc_id, n_tokens, ids, decoded_sha256."""
    return text_columns(docs).mapInArrow(released(_encoded(model_path, dropout, seed), "dropout"), "doc_id bigint, n_tokens bigint, ids array<int>, decoded_sha256 string")
