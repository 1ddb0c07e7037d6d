"""Token ids of whole texts by a tokenizers file.

Two facts about the byte-level files carry both ways of encoding below. The split
into words is made from left to right and no token crosses it; and a blank after a
character that is not white space always starts a new word, whatever stands before
or after. So the ids left and right of such a place do not depend on each other.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

#: White space beyond blank, tab and line ends, and signs near it.
_RARE_SPACE = "".join(map(chr, [
    0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000, 0xFEFF,
]))
_SPACE = "".join(map(chr, [
    0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000, 0xFEFF,
]))
_UNSURE = re.compile(f"[ \t\n\r] |[{_RARE_SPACE}]")
_SPACE = re.compile(rf"[\s{_RARE_SPACE}]")
_SEGMENT = 1 << 20  # characters taken at a time

#: Fixed value: the split into words of the byte-level files.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _as_ranks(path: str):
    """The file's vocabulary as merge ranks for a faster library, and its added words.

    Both libraries merge the pair of the lowest rank first, so they agree where the file
    splits words as above, lists its merges in the order of their ids and has nothing
    else that could change ids. Where any of this is not so, there are no ranks.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    added = [t["content"] for t in spec.get("added_tokens") or []]
    plain = (model.get("type") == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
             and split.get("use_regex", True) and not spec.get("normalizer") and not spec.get("post_processor")
             and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    ids = [model["vocab"].get("".join(m)) for m in merges]
    if not plain or None in ids or ids != sorted(set(ids)) or (ids and ids[0] < 256):
        return None, added
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(c): b for b, c in [*((b, b) for b in shown), *((b, 256 + k) for k, b in enumerate(hidden))]}
    tokens = {t: i for t, i in model["vocab"].items() if t not in added}
    if not all(c in byte for t in tokens for c in t):
        return None, added
    ranks = {bytes(byte[c] for c in t): i for t, i in tokens.items()}
    return tiktoken.Encoding("file", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}), added


_LOADED: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """One encoder per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class Encoder:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.dtype = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.ranks, self.added = _as_ranks(path)

    def _packed(self, text: str) -> bytes:
        if self.ranks is None or any(word in text for word in self.added):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return array(self.code, ids).tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of one text; a long one is taken in segments cut before a safe blank."""
        out, at = [], 0
        while len(text) - at > _SEGMENT:
            to = at + _SEGMENT
            while to > at and not safe(text, to):
                to -= 1
            if to == at:
                to = at + _SEGMENT
                while to < len(text) and not safe(text, to):
                    to += 1
            out.append(self._packed(text[at:to]))
            at = to
        return b"".join([*out, self._packed(text[at:])])

    def spliced(self, text: str, chunk: int, overlap: int):
        """Packed ids, chunk by chunk: overlapping chunks are encoded with offsets and
        joined where both have a token start that is safe; where the overlap has no
        such place it is doubled."""
        at, begin = 0, 0  # the chunk's first character; the first one not yet given out
        while True:
            end = at + chunk + overlap
            if end >= len(text):
                yield self._between(text[at:], begin - at, None)
                return
            step, width = at + chunk, overlap
            while True:
                here = self.library.encode(text[at:end], add_special_tokens=False)
                there = self.library.encode(text[step : min(len(text), end)], add_special_tokens=False)
                starts = {a + at for a, _ in here.offsets}
                place = next((p for p in (a + step for a, _ in there.offsets)
                              if p > step and p in starts and safe(text, p)), None)
                if place is not None or end >= len(text):
                    break
                width *= 2
                end = min(len(text), step + width)
            if place is None:
                yield self._between(text[at:], begin - at, None)
                return
            yield self._between(text[at:end], begin - at, place - at, here)
            at, begin = step, place

    def _between(self, text: str, low: int, high: int | None, done=None) -> bytes:
        """Packed ids of the tokens that start in [low, high)."""
        done = done or self.library.encode(text, add_special_tokens=False)
        start = np.array([a for a, _ in done.offsets], np.int64)
        ids = np.array(done.ids, self.dtype)
        take = start >= low
        if high is not None:
            take &= start < high
        return ids[take].tobytes()


def safe(text: str, place: int) -> bool:
    """Whether a word starts at ``place`` whatever stands around it."""
    return 0 < place < len(text) and text[place] in " \n\t\r" and not _SPACE.match(text[place - 1])
