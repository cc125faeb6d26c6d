"""Token ids of whole texts with a public tokenizer file, fast on texts that repeat words.

Both tokenizers used here cut a text into pre-tokens and encode each by itself, and no pre-token
reaches over a blank or line feed that follows a visible character, nor from a letter to ASCII
punctuation but the apostrophe. So a text may be cut there; the tokenizer encodes each different
part once, and a task remembers the ids of the parts it has seen. Parts not met before are encoded in
one call; the vocabulary tells where one ends, as it marks ids that hold a blank or end a word.
Texts with other white space, or more than one blank or line feed in a row, are cut by a slower rule.
"""

from __future__ import annotations

import os
import re
from functools import cache
from unicodedata import normalize

import numpy as np
from tokenizers import Tokenizer

#: Parts a task remembers, and the longest part worth remembering.
MEMO_PARTS, MEMO_CHARS = 1_000_000, 40
#: The same for tokenizers that drop white space, which have fewer different parts.
MEMO_WORDS = 400_000
#: Stands between other parts that are encoded in one call; an id of its own, so the parts stay apart.
SEPARATOR = "<|endoftext|>"
#: Fixed values of the tokenizer files: how an id's name ends when it ends a word, and how it begins
#: when its first byte is a blank.
WORD_END, BLANK = "</w>", "\u0120"

#: The lookbehind's \S is narrower than what the tokenizers take for visible.
_CUTS = re.compile(r"(?<=\S)(?=[ \n])")
#: Punctuation that may be cut off after letters.
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~"


class Encoder:
    """Text to little-endian unsigned 32-bit ids, as bytes."""

    def __init__(self, path: str, drops_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.joined = Tokenizer.from_file(path)
        self.separator = self.joined.token_to_id(SEPARATOR)
        self.drops_space = drops_space
        names = self.whole.get_vocab()
        #: Ids that are the last of a word, or the first of a part that follows on a blank.
        self.edges = np.zeros(max(names.values()) + 1, bool)
        marked = (lambda name: name.endswith(WORD_END)) if drops_space else (lambda name: name.startswith(BLANK))
        self.edges[[i for name, i in names.items() if marked(name)]] = True
        # A part as it is cut (without the blank it follows on) to its ids.
        self.known: dict[str, bytes] = {"": b""}

    def encode(self, parts: list[str]) -> list[bytes]:
        """The ids of each part, encoded by itself."""
        if len(parts) == 1 or any("<|" in p for p in parts):
            return [self._ids(self.whole, p).tobytes() for p in parts]
        ids = self._ids(self.joined, SEPARATOR.join(parts))
        ends = np.append(np.nonzero(ids == self.separator)[0], len(ids))
        starts = np.concatenate([[0], ends[:-1] + 1])
        return _pieces(ids, starts, ends)

    def _ids(self, tokenizer: Tokenizer, text: str) -> np.ndarray:
        (encoding,) = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(encoding.ids, "<u4")

    def _is_plain(self, part: str) -> bool:
        """Whether a part shows in the ids where it ends: a single word, or all after a single blank."""
        return part.isalpha() if self.drops_space else part[0] not in "\n\0"

    def _encode_plain(self, parts: list[str]) -> list[bytes]:
        """As ``encode``, for plain parts as they are cut: no separators, so about twice as fast."""
        if not parts:
            return []
        ids = self._ids(self.whole, " ".join(parts) if self.drops_space else " " + " ".join(parts))
        edges = np.nonzero(self.edges[ids])[0]
        if len(edges) != len(parts):  # letters that lower-casing or composing parts from their marks
            return self.encode(list(map(self.written, parts)))
        if self.drops_space:
            return _pieces(ids, np.concatenate([[0], edges[:-1] + 1]), edges + 1)
        return _pieces(ids, edges, np.append(edges[1:], len(ids)))

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """The ids of parts not met before."""
        cores: dict[str, tuple[str, str]] = {}
        wanted: set[str] = set()
        for part in missing:
            core = part.rstrip(_TAIL)
            letters = normalize("NFC", core[core[:1] == "\n" :]).lower()  # both can set marks apart
            if len(core) < len(part) and letters.isalpha():
                both = cores[part] = (core, "\0" + part[len(core) :])
                wanted.update(both)
            else:
                wanted.add(part)
        if len(self.known) > (MEMO_WORDS if self.drops_space else MEMO_PARTS):
            self.known = {"": b""}
        known = self.known
        plain, others = [], []
        for part in wanted.difference(known):
            (plain if self._is_plain(part) else others).append(part)
        found = dict(zip(plain, self._encode_plain(plain)))
        if others:
            found.update(zip(others, self.encode(list(map(self.written, others)))))
        for part, both in cores.items():
            found[part] = b"".join([found[p] if p in found else known[p] for p in both])
        known.update((p, ids) for p, ids in found.items() if len(p) <= MEMO_CHARS)
        return found

    def written(self, part: str) -> str:
        """How a part stands in the text: after one blank, unless it begins with a line feed or is
        marked as following on nothing."""
        if part[0] == "\0":
            return part[1:]
        return part if self.drops_space or part[0] == "\n" else " " + part

    def _slowly(self, text: str) -> bytes:
        return b"".join(self.encode(_CUTS.split(text)))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "\0" in text:
            return self._slowly(text)
        if self.drops_space:
            parts = text.replace("\n", " ").split(" ")
        else:
            parts = text.replace("\n", " \n").split(" ")
            if "" in parts or "\n" in parts or parts[0][0] == "\n":
                return self._slowly(text)
            parts[0] = "\0" + parts[0]
        ids = list(map(self.known.get, parts))
        if None in ids:
            missing = {p for p, i in zip(parts, ids) if i is None}
            if any(len(p.split()) != 1 or p[-1].isspace() for p in missing):
                return self._slowly(text)
            found = self._learn(missing)
            ids = [found[p] if i is None else i for p, i in zip(parts, ids)]
        return b"".join(ids)


def _pieces(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data = ids.tobytes()
    return [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]


def release() -> None:
    """Give back the memory of this worker's encoders; for tasks that need it and encode nothing."""
    encoder.cache_clear()


@cache
def encoder(path: str, drops_space: bool) -> Encoder:
    """One encoder per Python worker and tokenizer file."""
    return Encoder(path, drops_space)
