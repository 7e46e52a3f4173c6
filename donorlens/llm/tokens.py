"""Token ids of whole texts by the ``tokenizers`` library, with a bounded word cache.

Both public vocabularies split a text at white space before any merge, so the
ids of a text are the ids of its white-space-delimited pieces in order. Each
worker keeps the ids of the pieces it has seen (about ``CACHE_PIECES`` at most)
and lets the library encode the unseen pieces of a whole batch as one text, whose
ids are dealt back by the bytes each token stands for.
``PieceTokenizer`` is for the vocabulary that encodes white space (byte-level),
``WordTokenizer`` for the one that drops it and reads small letters only.
A text the piece rules do not cover exactly (odd white space, special-token
strings) is encoded whole.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHE_PIECES = 600_000
BATCH = 1024  # texts a caller should encode at once
_RUN = re.compile(r" ?\S+|\s+(?!\S)|\s+")
_STOPS = ".,;:!?"
_ODD = re.compile(r"[\x1c-\x1f]")  # white space to Python, not to the library
_SMALL_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+").fullmatch

# Kinds of bytes to ``WordTokenizer``; _OTHER are control characters and what is above ASCII.
_BLANK, _LETTER, _DIGIT, _APOSTROPHE, _MARK, _OTHER = range(6)


def _kind(byte: int) -> int:
    if byte == 0x20 or 0x09 <= byte <= 0x0D:
        return _BLANK
    if byte < 0x20 or byte > 0x7E:
        return _OTHER
    char = chr(byte)
    return _LETTER if char.isalpha() else _DIGIT if char.isdigit() else _APOSTROPHE if char == "'" else _MARK


def _cut(left: int, right: int) -> bool:
    """A piece begins between two bytes of these kinds."""
    if left == _BLANK or right == _BLANK:
        return right != _BLANK
    if _OTHER in (left, right):
        return False
    return _DIGIT in (left, right) or (left == _LETTER) != (right == _LETTER) and (left, right) != (_APOSTROPHE, _LETTER)


_KIND = bytes(map(_kind, range(256)))
_SMALL = bytes(range(256)).lower()
_CUT = np.array([left < 6 and right < 6 and _cut(left, right) for left in range(8) for right in range(8)])


class PieceTokenizer:
    """Ids under the vocabulary that encodes white space (byte-level).

    It also splits between a letter and a stop after it: a piece that ends in stops is put
    together from its word and its stops, so one word before many stops is learned once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task already has its core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=False)
        # bytes a token stands for: one per character of its byte-level name
        self.n_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for name, i in vocab.items():
            self.n_bytes[i] = len(name)
        self.exact: dict[str, bytes] = {}    # ids of the key as it stands
        self.blanked: dict[str, bytes] = {}  # ids of the key after one blank

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _plain(self, text: str) -> str | None:
        """The text with a single blank before every piece but the first; None: it has to be split by rule."""
        if "<|" in text or _ODD.search(text) or not text:
            return None
        if ("  " in text or "\n\n" in text or " \n" in text or "\n " in text
                or text[:1].isspace() or text[-1:].isspace()):
            return None
        return text.replace("\n", " \n")

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _together(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without inner white space, encoded as one text of blank-separated words."""
        sizes = [len(p.encode()) + 1 for p in pieces]
        text = " " + " ".join(pieces)
        ids = np.asarray(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        ends, want = np.cumsum(self.n_bytes[ids]), np.cumsum(sizes)
        at = np.searchsorted(ends, want) + 1
        if at[-1] != len(ids) or (ends[at - 1] != want).any():
            return self._one_by_one([" " + p for p in pieces])
        raw, cuts = ids.tobytes(), [0, *(4 * at).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, cache: dict[str, bytes], pieces: set[str], encode) -> None:
        """Adds the unseen ``pieces`` to ``cache``; their words and stops are learned before them."""
        if len(cache) > CACHE_PIECES:
            cache.clear()
        missing = pieces.difference(cache)
        made = []  # (piece, word, stops)
        for piece in missing:
            word = piece.rstrip(_STOPS)
            stops = piece[len(word):]
            if not word or not word[-1].isalpha():
                word, stops = piece, ""
            if stops:
                made.append((piece, word, stops))
        if made:
            missing.difference_update(m[0] for m in made)
            missing.update({m[1] for m in made}.difference(cache))
        missing = list(missing)
        for i in range(0, len(missing), 20_000):
            cache.update(zip(missing[i:i + 20_000], encode(missing[i:i + 20_000]), strict=True))
        if made:
            tails = {m[2] for m in made}.difference(self.exact)
            if tails:
                tails = list(tails)
                self.exact.update(zip(tails, self._one_by_one(tails), strict=True))
            cache.update({piece: cache[word] + self.exact[stops] for piece, word, stops in made})

    def _by_rule(self, text: str) -> bytes:
        """A text with odd white space: its pieces by the rules, or whole where these do not cover it."""
        if "<|" in text or _ODD.search(text):
            return self._whole(text)
        pieces = _RUN.findall(text)
        self._learn(self.exact, set(pieces), self._one_by_one)
        return b"".join(map(self.exact.__getitem__, pieces))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; an empty text has none.

        Pieces are told apart in Arrow buffers, so only the distinct ones of a batch become Python
        strings; the ids of all pieces are then gathered by number.
        """
        out: list[bytes | None] = [None] * len(texts)
        plain = [(i, p) for i, p in enumerate(map(self._plain, texts)) if p is not None]
        if plain:
            lists = pc.split_pattern(pa.array([p for _, p in plain], pa.large_string()), " ")
            coded = lists.flatten().dictionary_encode()
            ends = np.asarray(lists.offsets)
            code = coded.indices.to_numpy().astype(np.int64)
            words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist goes through a scalar a word
            cache = self.blanked
            ids = list(map(cache.get, words))
            unseen = [k for k, raw in enumerate(ids) if raw is None]
            # white space inside a piece: its texts are split by rule
            odd = np.zeros(len(words), bool)
            odd[[k for k in unseen if len(words[k].split()) != 1]] = True
            by_rule = np.add.reduceat(odd[code], ends[:-1]) > 0
            new = {words[k] for k in unseen if not odd[k]}
            # a line feed, not a blank, stands before some pieces; nothing before the first of a text
            after_break = {w for w in new if w[0] == "\n"}
            self._learn(cache, after_break, self._one_by_one)
            ids = [cache[w] if w in after_break else raw for w, raw in zip(words, ids)] if after_break else ids
            new -= after_break
            unseen = [k for k in unseen if ids[k] is None]
            first = coded.dictionary.take(pa.array(code[ends[:-1]])).to_pylist()
            fine = sorted({w for w, bad in zip(first, by_rule) if not bad})
            self._learn(self.exact, set(fine), self._one_by_one)
            place = {w: len(words) + k for k, w in enumerate(fine)}
            code[ends[:-1]] = [place.get(w, 0) for w in first]
            ids += [self.exact[w] for w in fine]
            self._learn(cache, new, self._together)
            for k in unseen:
                ids[k] = b"" if odd[k] else cache[words[k]]
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            start = np.cumsum(size) - size
            flat = np.frombuffer(b"".join(ids), "<u4")
            n = size[code]
            before = np.cumsum(n) - n
            total = int(n.sum())
            gathered = flat[np.repeat(start[code] - before, n) + np.arange(total)].tobytes()
            cuts = 4 * np.r_[before, total][ends]
            for (i, _), a, b, bad in zip(plain, cuts[:-1].tolist(), cuts[1:].tolist(), by_rule.tolist()):
                out[i] = None if bad else gathered[a:b]
        return [self._by_rule(t) if raw is None else raw for t, raw in zip(texts, out)]


class WordTokenizer:
    """Ids under the vocabulary that reads small letters and drops white space.

    The texts of a batch are cut into pieces in one byte buffer: at white space, around digits,
    between a letter and a mark after it, between a mark and a letter after it (not after an
    apostrophe, which may begin a ``'s``). The vocabulary's own rule splits at all these places, so
    the ids of a text are those of its pieces in order. Capitals of ASCII and Latin-1 become small
    on the way, so one word in many guises is one piece. Beside any other character nothing is cut,
    and the pieces that hold one keep their capitals: the library normalizes these itself.

    The ids of pieces are kept in two halves; when the recent half is full, the one before it is
    dropped, so what comes up often stays.
    """

    def __init__(self, path: str, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task already has its core
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # small Latin words need neither the normalizer nor the splitting rule: the same merges without them
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = None
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.library.get_vocab(with_added_tokens=False)
        # bytes a token stands for: one per character of its byte-level name
        self.n_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for name, i in vocab.items():
            self.n_bytes[i] = len(name.removesuffix(word_end) if name != word_end else name)
        self.recent: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _together(self, pieces: list[str], encoder) -> list[bytes]:
        """Ids of pieces without white space, encoded as one text of blank-separated pieces."""
        text = " ".join(pieces)
        ids = np.asarray(encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")
        if encoder.normalizer is not None:
            text = encoder.normalizer.normalize_str(text)
        sizes = [len(p.encode()) for p in text.split(" ")]
        ends, want = np.cumsum(self.n_bytes[ids]), np.cumsum(sizes)
        at = np.searchsorted(ends, want) + 1
        if len(sizes) != len(pieces) or at[-1] != len(ids) or (ends[at - 1] != want).any():
            return self._one_by_one(pieces)
        raw, cuts = ids.tobytes(), [0, *(4 * at).tolist()]
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, pieces: list[str]) -> None:
        small, unspaced, odd = [], [], []
        for piece in pieces:
            if _SMALL_LATIN(piece):
                small.append(piece)
            else:
                (unspaced if len(piece.split()) == 1 and not _ODD.search(piece) else odd).append(piece)
        for found, encode in ((small, lambda some: self._together(some, self.merges)),
                              (unspaced, lambda some: self._together(some, self.library)), (odd, self._one_by_one)):
            for i in range(0, len(found), 20_000):
                self.recent.update(zip(found[i:i + 20_000], encode(found[i:i + 20_000]), strict=True))

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        if len(self.recent) > CACHE_PIECES // 2:
            self.former, self.recent = self.recent, {}
        recent, former = self.recent, self.former.get
        found, new = list(map(recent.get, pieces)), []
        for k, raw in enumerate(found):
            if raw is None:
                piece = pieces[k]
                raw = former(piece)
                if raw is None:
                    new.append(k)
                else:
                    found[k] = recent[piece] = raw
        unseen = [pieces[k] for k in new]
        self._learn(unseen)
        for k, piece in zip(new, unseen):
            found[k] = recent[piece]
        return found

    def _pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and how many of them stand before the end of each text."""
        raws = [t.encode() for t in texts]
        own = b" ".join([*raws, b""])  # a blank after each text
        data, kind = (np.frombuffer(bytearray(own.translate(table)), np.uint8) for table in (_SMALL, _KIND))
        other = np.flatnonzero(kind == _OTHER)
        latin = other[data[other] == 0xC3]  # first bytes of Latin-1 letters, but for two signs
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
        kind[latin] = kind[latin + 1] = _LETTER
        data[latin + 1] |= np.where(data[latin + 1] < 0x9F, 0x20, 0).astype(np.uint8)
        begins = np.r_[kind[:1] != _BLANK, _CUT[kind[:-1] * np.uint8(8) + kind[1:]]]
        kept = kind != _BLANK
        starts, data, kind = np.flatnonzero(begins[kept]), data[kept], kind[kept]
        stops = np.r_[starts[1:], len(data)]
        other = np.flatnonzero(kind == _OTHER)
        if len(other):  # these pieces as they were
            hit = np.unique(np.searchsorted(starts, other, "right") - 1)
            size = stops[hit] - starts[hit]
            at = np.repeat(starts[hit] - np.cumsum(size) + size, size) + np.arange(size.sum())
            data[at] = np.frombuffer(own, np.uint8)[kept][at]
        ends = np.cumsum([len(raw) + 1 for raw in raws])
        ends -= np.searchsorted(np.flatnonzero(~kept), ends)
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), [
            None, pa.py_buffer(np.r_[starts, len(data)].astype(np.int64)), pa.py_buffer(data)])
        return pieces, np.searchsorted(starts, ends)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers; an empty text has none."""
        if not texts:
            return []
        special = ["<|" in t for t in texts]
        pieces, ends = self._pieces(["" if s else t for t, s in zip(texts, special)])
        coded = pieces.dictionary_encode()
        ids = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        gathered = pa.array(ids, pa.large_binary()).take(coded.indices)
        at = np.frombuffer(gathered.buffers()[1], np.int64, len(gathered) + 1)
        raw = memoryview(gathered.buffers()[2] or b"")
        cuts = np.r_[0, at[ends]].tolist()
        return [self._one_by_one([t])[0] if s else bytes(raw[a:b]) for t, s, a, b in zip(texts, special, cuts, cuts[1:])]


@lru_cache(maxsize=1)
def piece_tokenizer(path: str) -> PieceTokenizer:
    """The worker's tokenizer: later tasks of the same worker go on with its cache."""
    return PieceTokenizer(path)


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer: later tasks of the same worker go on with its cache."""
    return WordTokenizer(path)
