"""Exact encoding with the ``tokenizers`` library, a piece at a time.

A single space between two characters that are not white space always begins
a new pre-token in the byte-level and word-end vocabularies used here, so a
text may be cut before such spaces and its parts encoded on their own.  Parts
recur, so each worker keeps what the library gave for a part; the memory is
bounded by ``MEMO_PARTS``.

Byte-level vocabularies show more.  There one end of a line between two
characters that are not white space is a pre-token of its own, and so are the
marks at the end of a part, after letters; so ``word``, ``word,`` and the first
part of ``word.\nNext`` cost one encoding.  A part of letters alone is one
pre-token, which the library's model takes without the splitting and copying
of texts.  Other new parts go to the library many at a time, as one text: each
begins with a piece that starts with the space, and has no such piece elsewhere.

Arrow splits a group of texts, finds its different parts and puts the ids
together; Python sees each different part of a group once.
"""

from __future__ import annotations

import json
import os
import re
import string
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import kept

MEMO_PARTS = 600_000
#: characters of parts that go first when these are too many
LONG = 10
#: parts that the library gets as one text
JOINED = 8192
#: the character that a byte-level vocabulary has for each byte
BYTE_CHARS = {b: b for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
BYTE_CHARS |= {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in BYTE_CHARS)}
SPACE = chr(BYTE_CHARS[32])
#: after a letter, these begin a pre-token of a byte-level vocabulary
MARKS = string.punctuation
#: letters up to here are compared with the library's before parts of letters go to its model
LAST = "\uffff"
#: characters of texts whose parts are looked up together
GROUP = 1 << 20
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
_OPEN: dict[tuple, PartEncoder] = kept("tokens")


def _letters(word: str) -> bool:
    """Whether the word is letters alone, all of them up to LAST."""
    return word.isalpha() and (word.isascii() or max(word) <= LAST)


def _byte_level(words: str) -> str:
    """The characters that a byte-level vocabulary has for a text's bytes."""
    return words.encode().decode("latin-1").translate(BYTE_CHARS)


class PartEncoder:
    """Token ids (as little-endian unsigned 32-bit bytes) or token counts of whole texts."""

    def __init__(self, path: str, count_only: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.count_only = count_only
        how = json.loads(self.library.to_str())
        plain = how["normalizer"] is None and (how["pre_tokenizer"] or {}).get("type") == "ByteLevel" and how["pre_tokenizer"].get("use_regex")
        #: of each id, whether its piece starts with the space
        self.begins = None
        if plain:
            self.begins = np.zeros(self.library.get_vocab_size(with_added_tokens=True), dtype=bool)
            self.begins[[i for t, i in self.library.get_vocab(with_added_tokens=True).items() if t.startswith(SPACE)]] = True
        #: what the library gave for parts, and for those of LONG characters or more
        self.memo: dict[str, object] = {}
        self.long: dict[str, object] = {}
        self.odd: object = -(1 << 60) if count_only else 0
        self.none: object = 0 if count_only else b""
        #: whether any part was odd so far
        self.odds = False
        #: whether parts may be cut into letters, marks at their end, and lines
        self.cuts = bool(plain) and not how["pre_tokenizer"].get("add_prefix_space") and self._agrees()
        if self.cuts:
            self.tokenize = self.library.model.tokenize
            self.line = self.direct(["\n"])[0]

    def _agrees(self) -> bool:
        """Whether the library takes all letters as one pre-token, in these bytes, and no added token lies in letters and marks after them."""
        every = "".join(c for c in map(chr, range(ord(LAST) + 1)) if c.isalpha())
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        own = all(t and t[0] in MARKS and any(c.isalpha() for c in t) and not any(c.isspace() for c in t) for t in added)
        return own and [x for x, _ in self.library.pre_tokenizer.pre_tokenize_str(" " + every)] == [SPACE + _byte_level(every)]

    def direct(self, texts: list[str]) -> list:
        got = self.library.encode_batch_fast(texts, add_special_tokens=False)
        if self.count_only:
            return [len(e) for e in got]
        flat = np.fromiter(chain.from_iterable(e.ids for e in got), dtype="<u4").tobytes()
        ends = np.cumsum([0] + [4 * len(e) for e in got]).tolist()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def joined(self, parts: list[str]) -> list:
        """Ids of each part after a space, all encoded as one text."""
        ids = np.array(self.library.encode_batch_fast([" " + " ".join(parts)], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.flatnonzero(self.begins[ids])
        if len(at) != len(parts):  # some part holds a space of another kind
            return self.direct([" " + p for p in parts])
        if self.count_only:
            return np.diff(np.append(at, len(ids))).tolist()
        flat, at = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
        return [flat[a:b] for a, b in zip(at, at[1:], strict=False)]

    def held(self, part: str):
        """What the worker keeps for a part."""
        return (self.memo if len(part) < LONG else self.long).get(part)

    def words(self, words: list[str], after: str) -> list:
        """What the library's model gives for words of letters, each with ``after`` before it."""
        text = "!".join(words)
        if not text.isascii():
            words = _byte_level(text).split("!")
        tokenize = self.tokenize
        if self.count_only:
            return [len(tokenize(after + w)) for w in words]
        # one list of all: a list a word would be many objects for the collector to visit
        flat, ends = [], [0]
        for w in words:
            flat += [t.id for t in tokenize(after + w)]
            ends.append(4 * len(flat))
        flat = np.array(flat, dtype="<u4").tobytes()
        return [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def parts(self, parts: list[str]) -> list:
        """What the library gives for each part after a space."""
        if self.begins is None:
            return self.direct([" " + p for p in parts])
        return [x for i in range(0, len(parts), JOINED) for x in self.joined(parts[i : i + JOINED])]

    def pieces(self, parts, line: bool) -> dict:
        """What the library gives for parts without white space, each after a space or an end of a line (which is counted in).

        The memo has a part at the start of a line after a space, which no other part holds.
        """
        words, marked, others = set(), {}, []
        for p in parts:
            if _letters(p):
                words.add(p)
            else:
                w = p.rstrip(MARKS)
                if _letters(w):
                    marked[p] = w
                else:
                    others.append(p)
        key = " " if line else ""
        had = {w: x for w in set(marked.values()) - words if (x := self.held(key + w)) is not None}
        words.update(w for w in marked.values() if w not in had)
        words = list(words)
        new = dict(zip(words, self.words(words, "" if line else SPACE), strict=True))
        if line:
            new = {w: self.line + x for w, x in new.items()}
        tails = list({p[len(w) :] for p, w in marked.items()})
        tails = dict(zip(tails, self.direct(tails), strict=True))
        marked = {p: (new[w] if w in new else had[w]) + tails[p[len(w) :]] for p, w in marked.items()}
        new.update(marked)
        new.update(zip(others, self.direct(["\n" + p for p in others]) if line else self.parts(others), strict=True))
        return {key + p: x for p, x in new.items()} if line else new

    def learn(self, parts: list[str]) -> dict:
        """What the library gives for new parts after a space; the worker keeps up to MEMO_PARTS, those of several lines by line."""
        # a part with white space at an end: the space before it, or the next one, may not be a cut
        new = {p: self.odd for p in parts if not p or p.strip() is not p}
        self.odds = self.odds or bool(new)
        plain = [p for p in parts if p not in new] if new else parts
        lines = {}
        if self.cuts:
            for p in plain:
                if "\n" in p:
                    own = p.split("\n")
                    # an end of a line beside other white space is no place to cut
                    if all(x and x.strip() is x for x in own):
                        lines[p] = own
            firsts = {p for p in plain if p not in lines}
            firsts.update(own[0] for own in lines.values() if self.held(own[0]) is None)
            new.update(self.pieces(firsts, False))
            new.update(self.pieces({x for own in lines.values() for x in own[1:] if self.held(" " + x) is None}, True))
        else:
            new.update(zip(plain, self.parts(plain), strict=True))
        whole = {}
        for p, own in lines.items():
            keys = [own[0], *(" " + x for x in own[1:])]
            each = [new[k] if k in new else self.held(k) for k in keys]
            whole[p] = sum(each) if self.count_only else b"".join(each)
        if len(self.memo) + len(self.long) + len(new) > MEMO_PARTS:
            # long parts recur least
            self.long.clear()
            if len(self.memo) + len(new) > MEMO_PARTS:
                self.memo.clear()
        self.memo.update((p, x) for p, x in new.items() if len(p) < LONG)
        self.long.update((p, x) for p, x in new.items() if len(p) >= LONG)
        return new | whole if whole else new

    def whole(self, text: str):
        """One text cut at the sure places only, without the memo."""
        parts = _BETWEEN.split(text)
        got = self.direct([parts[0], *(" " + p for p in parts[1:])])
        return sum(got) if self.count_only else b"".join(got)

    def encode(self, texts: list[str]) -> list:
        """What the library gives for each text."""
        cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        ends, parts = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        first, at = ends[:-1], parts.indices.to_numpy()
        names = parts.dictionary.to_numpy(zero_copy_only=False)
        heads = names[at[first]].tolist()
        # each different part is looked up once; the first part of a text has no space before it
        after = np.ones(len(at), dtype=bool)
        after[first] = False
        used = np.zeros(len(names), dtype=bool)
        used[at[after]] = True
        long = pc.utf8_length(parts.dictionary).to_numpy() >= LONG
        order = np.concatenate((np.flatnonzero(used & ~long), np.flatnonzero(used & long)))
        keys, short = names[order].tolist(), np.count_nonzero(used & ~long)
        got = [*map(self.memo.get, keys[:short]), *map(self.long.get, keys[short:])]
        missing = [k for k, x in enumerate(got) if x is None]
        if missing:
            new = self.learn([keys[k] for k in missing])
            for k in missing:
                got[k] = new[keys[k]]
        place = np.zeros(len(names), dtype=np.int64)
        place[order] = np.arange(len(keys))
        place = place[at]
        place[first] = len(keys) + np.arange(len(texts))
        several = np.diff(ends) > 1
        # an empty head, or one that ends in white space, is no place to cut either
        again = several & np.array([not h or h[-1].isspace() for h in heads], dtype=bool)
        if self.odds:
            odd = np.array([x == self.odd for x in got] + [False] * len(heads), dtype=bool)
            again |= several & (np.diff(np.append(0, np.cumsum(odd[place]))[ends]) > 0)
            got = [self.none if x == self.odd else x for x in got]
        got += self.direct(heads)
        if self.count_only:
            out = np.diff(np.append(0, np.cumsum(np.array(got, dtype=np.int64)[place]))[ends]).tolist()
        else:
            ids = pa.array(got, pa.large_binary()).take(pa.array(place))
            flat, ends = ids.buffers()[2], np.frombuffer(ids.buffers()[1], dtype=np.int64)[ends].tolist()
            flat = memoryview(flat) if flat is not None else b""
            out = [bytes(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        for k in np.flatnonzero(again).tolist():
            out[k] = self.whole(texts[k])
        return out


def encoder(path: str, count_only: bool) -> PartEncoder:
    """The worker's encoder for a vocabulary file, kept from task to task."""
    key = (path, count_only)
    if key not in _OPEN:
        _OPEN[key] = PartEncoder(path, count_only)
    return _OPEN[key]


def text_groups(texts: list, chars: int = 1 << 19):
    """Indices of ``texts`` in runs of about ``chars`` characters; a null is an empty text."""
    run, size = [], 0
    for t in texts:
        run.append(t or "")
        size += len(run[-1])
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run
