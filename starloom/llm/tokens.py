"""Token ids of whole texts by a public tokenizer, word by word."""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import give_back

#: Stands between words that are encoded in one call: a token of its own.
MARK = "~"
_TAIL = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_ALNUM = np.array([k < 128 and chr(k).isalnum() for k in range(256)])
#: Bytes of text that are encoded at a time, about: 1,000 texts of a usual corpus.
STRETCH = 4_000_000


def stretches(sizes: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Where to cut texts of these sizes in bytes, so that about ``STRETCH``
    bytes, one text at least, are held at a time."""
    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        full = STRETCH + (int(ends[at - 1]) if at else 0)
        to = max(at + 1, int(np.searchsorted(ends, full, "right")))
        yield at, to
        at = to


def column_stretches(texts: pa.BinaryArray) -> Iterator[tuple[int, int]]:
    """``stretches`` of a column."""
    return stretches(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))


def _letters(word: bytes) -> bool:
    try:
        return word.isalpha() or not word.isascii() and word.decode("utf-8").isalpha()
    except UnicodeDecodeError:
        return False


def _ends_in_letter(word: bytes) -> bool:
    """Also as the tokenizer sees it: a few letters become a letter and a mark."""
    last = word.decode("utf-8", "replace")[-1]
    return unicodedata.normalize("NFC", last).lower()[-1].isalpha()


class WordEncoder:
    """Token ids of blank-separated words as little-endian unsigned 32-bit
    bytes. The tokenizer drops white space and looks at no text across it, so
    a text's ids are those of its words, one after the other. A word is its core
    and the punctuation behind it; each distinct one of these is looked up once
    for many texts, and encoded once. About ``limit`` of
    them are remembered, in two halves: when the newer one is full, the older
    one is forgotten but for the words that are met again, so frequent words
    stay known."""

    def __init__(self, path: str, limit: int = 1_200_000):
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one thread a task
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit

        self.mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        assert len(self.mark) == 1, "the mark between words must be one token"
        self.closing = self._closing()
        # the model's own memory of words costs more than it saves: each word is asked for once
        getattr(self.tokenizer.model, "_resize_cache", lambda n: None)(0)

    def _closing(self) -> np.ndarray | None:
        """Of each id, whether it ends a piece that the tokenizer cuts out of a
        text; None where that can't be seen from all of them."""
        from tokenizers.pre_tokenizers import ByteLevel
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocab = self.tokenizer.get_vocab()
        if not suffix or not all(c in vocab and c + suffix in vocab for c in ByteLevel.alphabet()):
            return None
        closing = np.zeros(max(vocab.values()) + 1, bool)
        closing[[k for token, k in vocab.items() if token.endswith(suffix)]] = True
        return closing

    def learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of ``words``, which are distinct; all are known from now on."""
        ids = list(map(self.known.get, words))
        missing = [k for k, x in enumerate(ids) if x is None]
        if self.known and 2 * (len(self.known) + len(missing)) > self.limit:
            self.older = self.known
            self.known = {w: x for w, x in zip(words, ids, strict=True) if x is not None}
        self._encode(self._unknown([words[k] for k in missing]))
        for k in missing:
            ids[k] = self.known[words[k]]
        return ids

    def _unknown(self, words: list[bytes]) -> list[bytes]:
        """Those of ``words``, none of them in the newer half, that the older
        one doesn't know either. Its words come to the newer half."""
        if not self.older:
            return words
        found = list(map(self.older.get, words))
        self.known.update([(w, x) for w, x in zip(words, found, strict=True) if x is not None])
        return [w for w, x in zip(words, found, strict=True) if x is None]

    def _encode(self, words: list[bytes]) -> None:
        letters, others = [], []
        for w in words:
            (letters if self.closing is not None and _letters(w) else others).append(w)
        for at in range(0, len(letters), 1000):  # one call for many words: ten times as fast
            if not self._encode_letters(letters[at:at + 1000]):
                others += letters[at:at + 1000]
        for at in range(0, len(others), 1000):
            self._encode_marked(others[at:at + 1000])

    def _encode_letters(self, words: list[bytes]) -> bool:
        """Encode words of letters alone, if each is one piece to the tokenizer.
        A letter is in some piece, so each word has a closing id at least; as
        many of them as words are one each."""
        ids = self._fast(b" ".join(words).decode("utf-8"))
        stops = np.flatnonzero(self.closing[ids]) + 1
        if len(stops) != len(words):
            return False
        self._keep(words, ids, np.concatenate([[0], stops[:-1]]), stops)
        return True

    def _fast(self, text: str) -> np.ndarray:
        # the fast call makes the same ids without their places in the text
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _keep(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> None:
        raw = ids.tobytes()
        self.known.update([(w, raw[i:j]) for w, i, j in zip(
            words, (4 * starts).tolist(), (4 * stops).tolist(), strict=True)])

    def _encode_marked(self, some: list[bytes]) -> None:
        joined = f" {MARK} ".encode().join(some)
        if joined.count(b"~") >= len(some) or b"<|" in joined:
            # by themselves: they hold the mark, or a special token
            self.known.update((w, self._ids(w)) for w in some if b"~" in w or b"<|" in w)
            some = [w for w in some if b"~" not in w and b"<|" not in w]
            joined = f" {MARK} ".encode().join(some)
        if not some:
            return
        try:
            text = joined.decode("utf-8")
        except UnicodeDecodeError:
            self.known.update((w, self._ids(w)) for w in some)
            return
        ids = self._fast(text)
        ends = np.flatnonzero(ids == self.mark[0])
        if len(ends) != len(some) - 1:  # cannot happen; each word by itself is right anyway
            self.known.update((w, self._ids(w)) for w in some)
            return
        self._keep(some, ids, np.concatenate([[0], ends + 1]), np.concatenate([ends, [len(ids)]]))

    def _ids(self, word: bytes) -> bytes:
        coded = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False)
        return np.asarray(coded.ids, "<u4").tobytes()

    def __call__(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text. NULL counts as empty."""
        out = []
        for at, to in stretches([len(t) if t else 0 for t in texts]):
            out += self._stretch([_lower(t) if t else b"" for t in texts[at:to]])
        return out

    def _stretch(self, texts: list[bytes]) -> list[bytes]:
        # Arrow cuts at the same six characters as ``bytes.split``; the kernel works on bytes
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        words = split.values.dictionary_encode()
        parts = _cores_and_tails(words.dictionary).dictionary_encode()
        ids = pa.array(self.learn(parts.dictionary.to_pylist()), pa.large_binary())
        of_words = parts.indices.to_numpy().reshape(-1, 2)[words.indices.to_numpy()]
        ids = ids.take(pa.array(of_words.ravel()))
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1)[2 * split.offsets.to_numpy()].tolist()
        raw = memoryview(data or b"")
        return [bytes(raw[i:j]) for i, j in zip(ends, ends[1:], strict=False)]


def _cores_and_tails(words: pa.StringArray) -> pa.BinaryArray:
    """Each word's core and the ASCII punctuation behind it, one after the
    other, so that many words share a core. The tokenizer surely cuts behind a
    letter or a digit; any other word is all core and has an empty tail."""
    _, offsets, data = words.buffers()
    data = data or pa.py_buffer(b"")
    starts = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset)
    trimmed = pc.binary_length(pc.ascii_rtrim(words, characters=_TAIL.decode())).to_numpy()
    stops = starts[:-1] + trimmed
    cut = (trimmed > 0) & (stops < starts[1:]) & ~pc.match_substring(words, "<|").to_numpy(zero_copy_only=False)
    last = np.frombuffer(data, np.uint8)[stops[cut] - 1]
    sure = _ALNUM[last]
    for k, at in zip(np.flatnonzero(last > 127), np.flatnonzero(cut)[last > 127], strict=True):
        sure[k] = _ends_in_letter(bytes(data[starts[at]:stops[at]]))
    cut[cut] = sure
    pairs = np.stack([starts[:-1], np.where(cut, stops, starts[1:])], axis=1).ravel()
    pairs = np.append(pairs, starts[-1]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(pairs) - 1, [None, pa.py_buffer(pairs), data])


def _lower(text: bytes) -> bytes:
    """``text`` with A-Z in lower case, so that fewer words are distinct. The
    tokenizer lower-cases all but its special tokens, but composes letters and
    marks before: texts with marks (U+0300 to U+037F) are left to it."""
    return text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower()


@functools.cache
def encoder(path: str, limit: int = 1_200_000) -> WordEncoder:
    """One encoder per Python worker. A remembered word takes about 190 bytes."""
    give_back()
    return WordEncoder(path, limit)


def public_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


def place(path: str | None) -> str:
    """``path``, or the public vocabulary file where it is None. Asked inside
    the task, as each machine has its own copy."""
    return path or public_path()
