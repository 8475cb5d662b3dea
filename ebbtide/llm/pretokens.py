"""Tokens of texts through a memo of their pre-tokens.

A byte-pair tokenizer never merges across its pre-token boundaries, so a text cut at boundaries
that hold in every context has the tokens of its parts, one after another. Two cuts are proven here:

* a space after a character that is no white space (no pre-token pattern runs from a non-space into
  a space, and white space is only joined to what follows);
* inside a part made of plain letters, digits and signs alone, the pre-token pattern itself, which
  is written out for that alphabet.

Everything else (apostrophes, special strings, odd white space, other scripts) goes to the library
as it stands. Each Python worker keeps the memo, bounded, between tasks: in two generations, so that
parts that come again outlive those that came once.
"""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from ebbtide.llm.worker import kept  # noqa: E402

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Parts of this alphabet are cut by the patterns below: no apostrophe, no "<", no white space.
PLAIN = re.compile(rf"[{LETTERS}0-9!-&(-;=-@\[-`{{-~]+")
#: Bytes a worker's memo holds, parts and words together; longer ones than this many characters aren't kept.
MEMO_BYTES = 64 << 20
LONGEST = 32
#: Of an entry, beside its text: two objects and its place in the dictionary, about.
ENTRY_BYTES = 180


def _byte_letters() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable ones as themselves, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = _byte_letters()


def _pieces(model, pre_token: str):
    return model.tokenize(pre_token.encode().decode("latin-1").translate(BYTE_LETTERS))


class _Memo(dict):
    """A dictionary that takes what it lacks from the generation before, or asks ``learn``."""

    def __init__(self, owner: _Memos, learn):
        self.owner, self.learn, self.before = owner, learn, {}

    def __missing__(self, text):
        found = self.before.get(text)
        if found is None:
            found = self.learn(text)
        if len(text) <= LONGEST:
            self.owner.weigh(ENTRY_BYTES + len(text) + (len(found) if isinstance(found, bytes) else 0))
            self[text] = found
        return found

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


class _Memos:
    """Memos of parts and of the words they are made of, within one bound.

    At half the bound a new generation begins and the one before last is forgotten.
    """

    def __init__(self):
        self.parts, self.words = _Memo(self, self._learn), _Memo(self, self._learn_word)
        self.held = 0

    def weigh(self, size: int) -> None:
        if self.held + size > MEMO_BYTES // 2:
            self.parts.turn()
            self.words.turn()
            self.held = 0
        self.held += size


class ByteCounts(_Memos):
    """Token counts of a byte-level tokenizer whose pre-tokens take one leading space."""

    CUT = re.compile(rf" ?[{LETTERS}]+| ?[0-9]+| ?[^ {LETTERS}0-9]+")

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def direct(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def _learn(self, part: str) -> int:
        """Tokens of ``" " + part``; hugely negative if the cut behind it isn't proven."""
        if not part or part[-1].isspace():
            n = -(1 << 60)
        elif PLAIN.fullmatch(part):
            n = sum(map(self.words.__getitem__, self.CUT.findall(" " + part)))
        else:
            n = self.direct(" " + part)
        return n

    def _learn_word(self, word: str) -> int:
        return len(_pieces(self.model, word))

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self.direct(text)
        total = self.direct(first) + sum(map(self.parts.__getitem__, rest))
        return total if total >= 0 else self.direct(text)


class WordIds(_Memos):
    """Ids of a tokenizer that folds case, drops white space and ends words: as little-endian uint16."""

    CUT = re.compile(rf"[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this tokenizer don't fit 16 bits")

    def _learn(self, part: str) -> bytes:
        """A word is a part of its own, so one memo holds both."""
        if part.isalpha() and part.isascii():
            words = [part.lower()]
        elif PLAIN.fullmatch(part):
            words = self.CUT.findall(part.lower())
        else:
            return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u2").tobytes()
        return self._learn_word(part) if words == [part] else b"".join(map(self.parts.__getitem__, words))

    def _learn_word(self, word: str) -> bytes:
        found = self.model.tokenize(word) if word.isascii() else _pieces(self.model, word)
        return b"".join([t.id.to_bytes(2, "little") for t in found])

    def ids(self, text: str) -> np.ndarray:
        parts = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.parts.__getitem__, parts)), "<u2")


def of_worker(kind, path: str):
    """The worker's own tokenizer of this kind and file."""
    return kept((kind, path), lambda: kind(path))
