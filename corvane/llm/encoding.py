"""Token ids of whole texts by the tokenizers library, which sees each distinct word once while a worker remembers it."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import gaps

#: Words that a worker remembers in each of two generations, of about 200 bytes each, texts that are encoded whole at once, bytes of texts
#: whose words are looked up at once, and new words that are encoded as one text.
REMEMBERED, TOGETHER, GROUP_BYTES, NEW = 300_000, 64, 4 << 20, 1_000
#: Marks that often end a word, and letters after which they are ids of their own.
MARKS = ".,;:!?\"')]}%$#&*|-"
LETTER_LAST = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]\\z"


#: White space other than space and newline, by the widest definition.
OTHER_SPACE = ("\t", "\v", "\f", "\r", *map(chr, range(0x1C, 0x20)), "\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000")
DOUBLED = ("  ", "\n\n", " \n", "\n ")
#: What a text has whose words don't all stand apart by one space or newline each.
IRREGULAR = f"[{''.join(OTHER_SPACE)}]|{'|'.join(DOUBLED)}| \\z"


def offsets(x: pa.Array) -> np.ndarray:
    """Where the values of a string, binary or list array begin, and the end of the last."""
    return np.frombuffer(x.buffers()[1], np.int32, len(x) + 1, 4 * x.offset)


def parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word without the marks at its end, and these marks; words whose marks don't follow a letter stay whole."""
    cores = pc.utf8_rtrim(words, MARKS)
    cores = pc.if_else(pc.match_substring_regex(cores, LETTER_LAST), cores, words)
    at = offsets(words)
    both = np.empty(2 * len(words) + 1, np.int32)
    both[::2], both[1::2] = at, at[:-1] + pc.binary_length(cores).to_numpy()
    halves = pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(both), words.buffers()[2])
    return cores, halves.take(pa.array(np.arange(1, 2 * len(words), 2)))


class Encoder:
    """encode(texts) gives, for each text, the bytes of its ids as little-endian integers of `width` bytes; encoded(column) gives
    them as binary columns, for one group of texts after the other.

    A pre-tokenizer that splits by the usual byte-level pattern never joins a character that isn't white space with a
    following space or newline. So a word with the one space or newline before it is encoded on its own with the same ids, and
    most words are remembered; marks after a letter at its end are ids of their own. A group's words are split, told apart and
    put together again as Arrow columns, so Python sees each distinct one once. New words are encoded as one text, and parted
    where an id's text starts with their white space. Other tokenizers, and texts with other white space than single spaces and
    newlines between words, are encoded whole."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Its own memory of words only costs time, as it gets each word once.
        if self.by_word and hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)
        vocab = self.tokenizer.get_vocab()
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        # The byte-level alphabet writes a space as U+0120 and a newline as U+010A.
        self.starts = {}
        for white, sign in ((" ", "Ġ"), ("\n", "Ċ")):
            self.starts[white] = np.zeros(max(vocab.values()) + 1, bool)
            self.starts[white][[i for t, i in vocab.items() if t.startswith(sign)]] = True
        #: By word without its last marks, or newline and word; a word stands for itself after a space.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    @property
    def dtype(self) -> str:
        return f"<u{self.width}"

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, names: list[str], white: str) -> None:
        """Learns words that follow `white`, NEW of them as one text."""
        keys = names if white == " " else [white + n for n in names]
        for i in range(0, len(names), NEW):
            ids = np.array(self.tokenizer.encode_batch_fast([white + white.join(names[i : i + NEW])], add_special_tokens=False)[0].ids, dtype=self.dtype)
            starts = (np.flatnonzero(self.starts[white][ids]) * self.width).tolist()
            data = ids.tobytes()
            self.known.update(zip(keys[i : i + NEW], [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)], strict=True))

    def _tail(self, marks: str) -> bytes:
        if marks not in self.tails:
            if len(self.tails) > self.remembered // 4:
                self.tails.clear()
            self.tails[marks] = self._whole([marks])[0]
        return self.tails[marks]

    def _learn(self, new: list[str]) -> None:
        self._words([w for w in new if w[0] != "\n"], " ")
        self._words([w[1:] for w in new if w[0] == "\n" and len(w) > 1], "\n")
        if "\n" in new:
            self.known["\n"] = self._whole(["\n"])[0]

    def _found(self, names: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        if len(self.known) > self.remembered:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        found = list(map(known.get, names))
        holes = gaps(found)
        if holes:
            known.update((w, older[w]) for w in (names[k] for k in holes) if w in older)
            self._learn([w for w in (names[k] for k in holes) if w not in known])
            for k in holes:
                found[k] = known[names[k]]
        return found

    def _regular(self, texts: pa.Array) -> pa.Array:
        """The ids of texts whose words stand apart by one space or newline each."""
        # A newline goes before each text: its first word, too, is then one after a newline.
        lists = pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")
        words = lists.flatten().dictionary_encode()
        cores, marks = (x.dictionary_encode() for x in parted(words.dictionary))
        ids = pa.array(self._found(cores.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.binary()).take(cores.indices)
        tails = pa.array([self._tail(m) for m in marks.dictionary.to_pylist()], pa.binary()).take(marks.indices)
        flat = pc.binary_join_element_wise(ids, tails, b"").take(words.indices)
        ends = offsets(flat)[offsets(lists) - offsets(lists)[0]]
        # That newline's id goes again.
        both = np.empty(2 * len(texts) + 1, np.int32)
        both[::2], both[1::2] = ends, ends[:-1] + self.width
        return pa.BinaryArray.from_buffers(pa.binary(), 2 * len(texts), [None, pa.py_buffer(both), flat.buffers()[2]]).take(pa.array(np.arange(1, 2 * len(texts), 2)))

    def _group(self, texts: pa.Array) -> pa.Array:
        odd = pc.match_substring_regex(texts, IRREGULAR)
        at = odd.to_numpy(zero_copy_only=False)
        if not at.any():
            return self._regular(texts)
        whole = pa.array([self._whole([t])[0] for t in texts.filter(odd).to_pylist()], pa.binary())
        if at.all():
            return whole
        both = pa.concat_arrays([self._regular(texts.filter(pc.invert(odd))), whole])
        return both.take(pa.array(np.argsort(np.argsort(at, kind="stable"), kind="stable")))

    def encoded(self, texts: pa.Array) -> Iterator[pa.Array]:
        """The ids of a column of texts, group by group in its order; a null text has none."""
        texts = texts.cast(pa.string()).fill_null("")
        if not self.by_word:
            for i in range(0, len(texts), TOGETHER):
                yield pa.array(self._whole(texts[i : i + TOGETHER].to_pylist()), pa.binary())
            return
        group = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64) // GROUP_BYTES
        edges = [*np.flatnonzero(np.diff(group, prepend=-1)).tolist(), len(texts)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield self._group(texts[a:b])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [data for ids in self.encoded(pa.array(texts, pa.string())) for data in ids.to_pylist()]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """The one of a worker process, kept from task to task."""
    if (path, remembered) not in _encoders:
        _encoders.clear()
        _encoders[path, remembered] = Encoder(path, remembered)
    return _encoders[path, remembered]


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
