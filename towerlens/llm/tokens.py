"""Token ids of whole texts with a public tokenizer file, memoised by pre-token.

Words repeat, so each distinct pre-token is encoded by the library once per
memo. Texts of plain Latin letters are cut by the tokenizer's own pre-token
pattern (its classes spelled out for those letters), and the library's model
encodes each pre-token by itself as the memo misses it; any other text is cut
before every single space that has a visible character on both sides, a place
that no pre-token spans, and the whole tokenizer encodes many such parts at a
time. Either way the ids of a text are the ids of its parts, one after the
other; the tests compare with direct encoding.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np

#: White space or invisible in any engine: no cut beside these.
_ODD = r"\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_IRREGULAR = re.compile(rf" (?:$|[{_ODD}])|(?:^|[{_ODD}]) ")
_CUT = re.compile(rf"(?<=[^{_ODD}]) (?=[^{_ODD}])")

#: Plain texts: ASCII and the letters of Latin-1, in which both engines see the same classes. "<|" may start a special token.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NOT_PLAIN = re.compile(rf"[^\t\n\r\x20-\x7e{_LETTERS}]")
#: Pre-token patterns of the two kinds of tokenizer (fixed by their files).
_BYTE_PATTERN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")
_WORD_PATTERN = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")

#: Parts of a generation of the memo (about 180 bytes each). When one is full it becomes the older one and the one before it goes,
#: so a worker holds two generations (about 50 MB), and words that keep coming stay.
GENERATION = 140_000
#: Parts longer than this are encoded each time.
MEMO_LENGTH = 48


def pieces(text: str) -> list[str]:
    """Cut any text; every piece but the first keeps its leading space."""
    if not text:
        return []
    parts = text.split(" ") if not _IRREGULAR.search(text) else _CUT.split(text)
    return [parts[0], *[" " + p for p in parts[1:]]]


class _Memo(dict):
    """Ids of parts. A pre-token that is not there comes from the generation before, or else from ``encode``, and stays if it is short."""

    def __init__(self, encode, older: dict[str, bytes]):
        self.encode, self.older = encode, older

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part) or self.encode(part)
        if len(part) <= MEMO_LENGTH:
            self[part] = ids
        return ids


class PartEncoder:
    """Encodes batches of texts to little-endian unsigned 32-bit ids (bytes)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.memo = _Memo(self._pre_token, {})
        spec = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        before = spec["pre_tokenizer"] or {}
        self.pattern, self.lower = None, False
        if spec["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]:
            self.pattern = _BYTE_PATTERN
        elif steps == ["NFC", "Replace", "Lowercase"] and spec["model"].get("end_of_word_suffix"):
            self.pattern, self.lower = _WORD_PATTERN, True
        # The letters that the library's models know the bytes of a plain character by.
        letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: letters.pre_tokenize_str(chr(c))[0][0] for c in range(1, 256)}

    @property
    def older(self) -> dict[str, bytes]:
        return self.memo.older

    def _pre_token(self, part: str) -> bytes:
        """Ids of a single pre-token of plain letters."""
        return array("I", [t.id for t in self.model.tokenize(part.translate(self.letters))]).tobytes()

    def _plain(self, text: str) -> bool:
        return self.pattern is not None and not _NOT_PLAIN.search(text) and "<|" not in text

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _turn(self) -> None:
        if len(self.memo) > GENERATION:
            older, self.memo.older = self.memo, {}
            self.memo = _Memo(self._pre_token, older)

    def _fill(self, wanted: set[str]) -> list[str]:
        """Parts of other texts that neither generation knows, encoded as texts of their own; returns them."""
        memo, older = self.memo, self.older
        missing = [p for p in wanted if p not in memo]
        memo.update((p, older[p]) for p in missing if p in older)
        missing = [p for p in missing if p not in memo]
        for at in range(0, len(missing), 4096):
            part = missing[at:at + 4096]
            memo.update(zip(part, (i.tobytes() for i in self._ids(part)), strict=True))
        return missing

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        other: list[tuple[int, list[str]]] = []
        for t in texts:
            if self._plain(t):
                self._turn()
                out.append(b"".join(map(self.memo.__getitem__, self.pattern.findall(t.lower() if self.lower else t))))
            else:
                other.append((len(out), pieces(t)))
                out.append(b"")
        if other:
            self._turn()
            filled = self._fill(set(chain.from_iterable(c for _, c in other)))
            for n, cut in other:
                out[n] = b"".join(map(self.memo.__getitem__, cut))
            for p in filled:
                if len(p) > MEMO_LENGTH:
                    del self.memo[p]
        return out


_ENCODERS: dict[str, PartEncoder] = {}


def encoder(path: str) -> PartEncoder:
    """The encoder of this Python worker, kept for its next tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PartEncoder(path)
    return _ENCODERS[path]


def encode_documents(texts, path: str, end_id: int, batch_chars: int = 2_000_000):
    """Yield for each text (null: empty) its ids with ``end_id`` appended, as an unsigned 32-bit array."""
    enc, end = encoder(path), np.array([end_id], dtype="<u4").tobytes()
    waiting: list[str] = []
    held = 0
    for t in texts:
        waiting.append(t if isinstance(t, str) else "")
        held += len(waiting[-1])
        if held >= batch_chars:
            yield from (np.frombuffer(b + end, dtype="<u4") for b in enc.encode(waiting))
            waiting, held = [], 0
    yield from (np.frombuffer(b + end, dtype="<u4") for b in enc.encode(waiting))
