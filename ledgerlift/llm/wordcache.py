"""Token ids of whole texts through their distinct words.

A tokenizer qualifies if no token, normalisation or special token reaches
across ASCII white space; then the ids of a text are the ids of its words, one
after another, and only distinct words need encoding.  :func:`by_words` tells from the
tokenizer's file whether it is of the one kind known to qualify (lower-casing, cut into
letters, single digits and other signs, white space dropped); ``word_bpe_49k`` is
(tests compare with whole-text encoding).  Others go through :class:`WholeTexts`.

Pools live as long as the Python worker (:func:`kept`), so the tasks that a worker runs
one after another share them; a new worker, after a loss too, starts with empty ones.

Words are matched by a 64-bit hash *and* checked by length, first and last
eight bytes against the word that the hash stands for; a slice of text that
fails this check is encoded word by word (:class:`JoinedWords`: text by text).
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from ledgerlift.llm import words

KEEP = 400_000           # distinct words kept by a worker; beyond, it starts anew

# The normaliser and the cut of a tokenizer file that is read word by word.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
CUT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def by_words(spec: dict) -> bool:
    """Whether the ids of a text are the ids of its words, for a parsed tokenizer file."""
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) and
                not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    return plain and spec["model"]["type"] == "BPE" and spec["normalizer"] == NORMALIZER \
        and spec["pre_tokenizer"] == CUT


_KEPT: dict = {}


def kept(key, make):
    """``make()`` for this key, kept by the Python worker across its tasks; two keys at most."""
    if key not in _KEPT:
        if len(_KEPT) > 1:
            _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def ends_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """``(size, begin, end)`` of each span of bytes: its length, its first and its last eight bytes."""
    size = ends - starts
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[8:len(data) + 8] = data
    lanes = np.ndarray((len(data) + 9,), "<u8", padded.data, strides=(1,))
    return size, lanes[starts + 8] & words.LANE[np.minimum(size, 8)], lanes[ends] & ~words.LANE[8 - np.minimum(size, 8)]


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """``(list of distinct words as bytes, index into it for each word)``."""
    blob = data.tobytes()
    _, head, inverse = np.unique(words.hashes(data, starts, ends), return_index=True, return_inverse=True)
    size, begin, end = ends_of(data, starts, ends)
    other = head[inverse]
    if (size != size[other]).any() or (begin != begin[other]).any() or (end != end[other]).any():
        head, inverse = np.arange(len(starts)), np.arange(len(starts))  # an equal hash of unequal words
    return [blob[a:b] for a, b in zip(starts[head].tolist(), ends[head].tolist(), strict=True)], inverse


ENCODE_BYTES = 2 << 20   # text encoded together

# Words for which the tokenizer's normaliser and cut are plain: printable ASCII without an
# apostrophe, and Latin-1 letters (all NFC; lower case maps one character to one).
PLAIN = re.compile(r"[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
PIECES = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def is_plain(word: str, special: list[str]) -> bool:
    return PLAIN.fullmatch(word) is not None and not ("<" in word and any(s in word for s in special))


def gathered(ids: np.ndarray, begin: np.ndarray, count: np.ndarray):
    """The runs of ``count`` ids from ``begin`` on, one after another, and where each begins (and the last ends)."""
    before = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=before[1:])
    return ids[np.arange(before[-1]) + np.repeat(begin - before[:-1], count)], before


# Bytes by the pieces that they belong to: white space, letters, digits, other signs of plain words, and
# bytes whose words are not plain.  Of two-byte characters the first byte 0xC3 is a letter's and ``_cut`` sees to the second.
GAP, LETTER, DIGIT, SIGN, APART = range(5)
KIND = np.full(256, APART, np.uint8)
KIND[0x21:0x7F] = SIGN
KIND[0x27] = APART
KIND[0x30:0x3A] = DIGIT
KIND[0x41:0x5B] = KIND[0x61:0x7B] = KIND[0xC3] = LETTER
KIND[words.SPACE] = GAP
JOINED_RUN = 1 << 12     # pieces encoded as one text
KEEP_PIECES = 1 << 21    # pieces kept by a worker, in arrays (about 60 bytes each); beyond, it starts anew


def _grown(array: np.ndarray, least: int) -> np.ndarray:
    if least <= len(array):
        return array
    out = np.zeros(max(least, len(array) * 3 // 2), array.dtype)
    out[:len(array)] = array
    return out


class _Pool:
    """Ids of spans of bytes by their 64-bit hashes: arrays, found through a table of slots (open addressing)."""

    def __init__(self):
        self.table = np.full(1 << 17, -1, np.int32)
        self.hash, self.begin, self.end = (np.zeros(1 << 16, np.uint64) for _ in range(3))
        self.size, self.at, self.ids = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32)
        self.count = 0

    def _first(self, key: np.ndarray) -> np.ndarray:
        return (key >> np.uint64(65 - len(self.table).bit_length())).astype(np.int64)

    def find(self, key: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 where it is not there."""
        at = self._first(key)
        slot = self.table[at]
        left = np.flatnonzero((slot >= 0) & (self.hash[slot] != key))
        while left.size:
            at[left] = (at[left] + 1) & (len(self.table) - 1)
            slot[left] = self.table[at[left]]
            left = left[(slot[left] >= 0) & (self.hash[slot[left]] != key[left])]
        return slot

    def _enter(self, slot: np.ndarray) -> None:
        at = self._first(self.hash[slot])
        left = np.arange(len(slot))
        while left.size:
            free = left[self.table[at[left]] < 0]
            self.table[at[free]] = slot[free]  # one of those for the same place stays in it
            left = left[self.table[at[left]] != slot[left]]
            at[left] = (at[left] + 1) & (len(self.table) - 1)

    def add(self, key, size, begin, end, ids, count) -> None:
        """New distinct hashes, with their spans' ends, all their ids and the number of each one's."""
        old, new, used = self.count, self.count + len(key), int(self.at[self.count])
        for name, values in (("hash", key), ("size", size), ("begin", begin), ("end", end)):
            array = _grown(getattr(self, name), new)
            array[old:new] = values
            setattr(self, name, array)
        self.at, self.ids = _grown(self.at, new + 1), _grown(self.ids, used + len(ids))
        self.at[old + 1:new + 1] = used + np.cumsum(count)
        self.ids[used:used + len(ids)] = ids
        self.count = new
        if 2 * new > len(self.table):
            self.table = np.full(1 << (2 * new).bit_length(), -1, np.int32)
            old = 0
        self._enter(np.arange(old, new, dtype=np.int32))


class JoinedWords:
    """Ids of texts: plain words by their pieces, each new piece encoded once, many at a time as one text
    of the library; other words one by one.

    ``whole`` encodes a text, ``pieces`` a text of lower-case pieces with spaces between.  Each
    piece ends with a token that bears the model's end-of-word suffix, which tells where its ids end."""

    def __init__(self, whole, pieces, vocab: dict[str, int], suffix: str, special: list[str], keep: int = KEEP_PIECES):
        self.whole, self.pieces, self.special, self.keep = whole, pieces, [s.encode() for s in special], keep
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.pool = _Pool()

    def _cut(self, data: np.ndarray, offsets: np.ndarray):
        """``(lower-case bytes, starts and ends of the pieces in them, starts and ends of the words that are not plain)``."""
        kind, low = KIND[data], words.LOWER[data]
        second = np.flatnonzero(data == 0xC3) + 1
        letter = (data[second] != 0x97) & (data[second] != 0xB7)  # not the signs of times and division
        kind[second[letter]] = LETTER
        low[second[letter & (data[second] < 0x9F)]] += 0x20
        apart = [np.flatnonzero(kind == APART)]
        blob = data.tobytes()
        for s in self.special:
            apart += [np.array([m.start()]) for m in re.finditer(re.escape(s), blob)]
        apart = np.concatenate(apart)
        starts, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(apart):
            starts, ends, _ = words.spans(data, offsets)
            which = np.zeros(len(starts), bool)
            which[np.searchsorted(starts, apart, "right") - 1] = True
            starts, ends = starts[which], ends[which]
            inside = np.zeros(len(data) + 1, np.int8)
            inside[starts] += 1
            inside[ends] -= 1
            kind[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)] = GAP
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        change = edge[1:-1] | (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        begins, finishes = kind != GAP, kind != GAP
        begins[1:] &= change
        finishes[:-1] &= change
        return low, np.flatnonzero(begins), np.flatnonzero(finishes) + 1, starts, ends

    def _encoded(self, fresh: list[str]):
        """``(ids, ids of each)`` of lower-case pieces."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for lo in range(0, len(fresh), JOINED_RUN):
            some = fresh[lo:lo + JOINED_RUN]
            new = np.array(self.pieces(" ".join(some)), np.uint32)
            end = np.flatnonzero(self.closes[new]) + 1
            if len(end) != len(some) or end[-1] != len(new):
                raise ValueError("the tokenizer cuts words otherwise than its file says")
            ids.append(new)
            sizes.append(np.diff(end, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    def _slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: np.uint64, encoded) -> np.ndarray | None:
        """The pool's slot of each span; ``encoded`` gets the new ones. None if unequal spans have an equal hash."""
        pool, key = self.pool, words.hashes(data, starts, ends) ^ salt
        size, begin, end = ends_of(data, starts, ends)
        slot = pool.find(key)
        missing = np.flatnonzero(slot < 0)
        if missing.size:
            new, one, back = np.unique(key[missing], return_index=True, return_inverse=True)
            one, blob = missing[one], data.tobytes()
            fresh = [blob[a:b].decode("utf-8") for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)]
            slot[missing] = pool.count + back
            pool.add(new, size[one], begin[one], end[one], *encoded(fresh))
        if (pool.size[slot] != size).any() or (pool.begin[slot] != begin).any() or (pool.end[slot] != end).any():
            return None
        return slot

    def _singly(self, fresh: list[str]):
        lists = [self.whole(word) for word in fresh]
        return np.fromiter(chain.from_iterable(lists), np.uint32), np.fromiter(map(len, lists), np.int64, len(lists))

    def ids_of(self, data: np.ndarray, offsets: np.ndarray):
        """``(ids, offsets)``: the ids of all rows of a slice, and where each row's begin."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.pool.count > self.keep:
            self.pool = _Pool()
        low, starts, ends, apart, apart_ends = self._cut(data, offsets)
        slot = self._slots(low, starts, ends, np.uint64(0), self._encoded)
        if slot is not None and len(apart):
            others = self._slots(data, apart, apart_ends, words.odd(7), self._singly)
            place = np.searchsorted(starts, apart)
            slot = None if others is None else np.insert(slot, place, others)
            starts = np.insert(starts, place, apart)
        if slot is None:
            return WholeTexts(self.whole).ids_of(data, offsets)
        at = self.pool.at
        ids, before = gathered(self.pool.ids, at[slot], at[slot + 1] - at[slot])
        return ids, before[np.searchsorted(starts, offsets)]

    def words(self, texts: list[str]):
        """``(ids, ids of each word)`` of words without white space."""
        blobs = [text.encode("utf-8") for text in texts]
        offsets = np.cumsum([0, *map(len, blobs)])
        ids, at = self.ids_of(np.frombuffer(b"".join(blobs), np.uint8), offsets)
        return ids, np.diff(at)


class PieceCache:
    """Ids of words: plain words by their pieces, each piece encoded once; others as a whole.

    ``piece`` gets the UTF-8 bytes of a piece, ``word`` a whole word."""

    def __init__(self, piece, word, special: list[str], keep: int = KEEP):
        self.piece, self.word, self.special, self.keep = piece, word, special, keep
        self.known: dict[str, tuple[int, ...]] = {}

    def words(self, texts: list[str]) -> list[list[int]]:
        if len(self.known) > self.keep:
            self.known = {}
        known, out = self.known, []
        for text in texts:
            if not is_plain(text, self.special):
                out.append(self.word(text))
                continue
            ids: list[int] = []
            for piece in PIECES.findall(text.lower()):
                found = known.get(piece)
                if found is None:
                    found = known[piece] = tuple(self.piece(piece.encode()))
                ids += found
            out.append(ids)
        return out


class WordCache:
    """Pool of the ids of the words seen so far; ``encode`` maps a list of words to id lists."""

    def __init__(self, encode, keep: int = KEEP):
        self.encode, self.keep = encode, keep
        self._clear()

    def _clear(self):
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 16, np.int64)       # first id of each word, and the end of the last
        self.count = 0

    def _add(self, fresh: list[bytes]) -> None:
        found = self.encode(b" ".join(fresh).decode("utf-8").split(" "))
        ids, sizes = np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        ends = self.at[self.count] + np.cumsum(sizes)
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        while self.count + len(fresh) >= len(self.at):
            self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
        self.ids[ends[0] - sizes[0]:ends[-1]] = ids
        self.at[self.count + 1:self.count + 1 + len(fresh)] = ends
        self.place.update(zip(fresh, range(self.count, self.count + len(fresh))))
        self.count += len(fresh)

    def _places(self, distinct: list[bytes]) -> np.ndarray:
        if self.count > self.keep:
            self._clear()
        found = list(map(self.place.get, distinct))
        fresh = [w for w, at in zip(distinct, found, strict=True) if at is None]
        if fresh:
            self._add(fresh)
            found = list(map(self.place.__getitem__, distinct))
        return np.array(found, np.int64)

    def ids_of(self, data: np.ndarray, offsets: np.ndarray):
        """``(ids, offsets)``: the ids of all rows of a slice, and where each row's begin."""
        starts, ends, first = words.spans(data, offsets)
        distinct, inverse = distinct_words(data, starts, ends)
        place = self._places(distinct)[inverse]
        ids, before = gathered(self.ids, self.at[place], self.at[place + 1] - self.at[place])
        return ids, before[first]


class WholeTexts:
    """``ids_of`` for a tokenizer whose ids depend on more than single words."""

    def __init__(self, encode):
        self.encode = encode

    def ids_of(self, data: np.ndarray, offsets: np.ndarray):
        """``(ids, offsets)`` as :meth:`WordCache.ids_of`, each text encoded as a whole."""
        blob = data.tobytes()
        lists = [self.encode(blob[a:b].decode("utf-8")) for a, b in zip(offsets.tolist(), offsets[1:].tolist())]
        at = np.zeros(len(lists) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)), out=at[1:])
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(at[-1])), at
