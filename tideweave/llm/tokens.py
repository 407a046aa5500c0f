"""Token ids of whole texts by a public tokenizer file, with a memo of words.

Where a tokenizer drops white space and never joins characters across it, the ids of a text are the
ids of its white-space delimited chunks in order. Each worker keeps the ids of chunks it has met,
and the library encodes every new one. A tokenizer without that property encodes whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa

from tideweave.llm.common import CACHES, trim

#: Chunks kept per worker, about 120 MB; when it is full, rarer chunks are encoded anew.
MEMO_WORDS = 600_000
#: Rows handled at once.
ROWS = 256
#: New chunks encoded in one call, with BAR between them.
AT_ONCE, BAR = 512, "|"
#: Trailing marks that may be split from a letter or digit: none begins or joins anything there.
MARKS = b'.,;:!?#$%&*"()-_/+='

_memos: dict[str, WordIds] = {}
CACHES.append(_memos)


def _bytes(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


class WordIds(dict):
    """Little-endian unsigned 32-bit ids by chunk."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._batch = Tokenizer.from_file(path).encode_batch_fast
        one = self._ids
        self.by_chunk = one([" \ta \r\n\x0b\x0cb "]) == one(["a b"]) == [one(["a"])[0] + one(["b"])[0]]
        self.folds_case = one(["ABCDEFGHIJKLMNOPQRSTUVWXYZ"]) == one(["abcdefghijklmnopqrstuvwxyz"])
        marks = [m.decode() for m in (MARKS[i : i + 1] for i in range(len(MARKS)))]
        a, seven = one(["a", "7"])
        self.splits_marks = one([f"{x}{m}{m}" for x in "a7" for m in marks]) == [
            x + y for x in (a, seven) for y in one([m + m for m in marks])
        ]
        bar = one([BAR])[0]
        self.bar = int.from_bytes(bar, "little") if len(bar) == 4 else None
        self._letters = self._lighter(path) if self.by_chunk and self.folds_case and self.bar is not None else None

    def _lighter(self, path: str):
        """The same model for chunks of a-z only, where normalising and splitting change nothing; None if they might."""
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        named = lambda x, key: {y["type"] for y in (x or {}).get(key, [x] if x else [])}
        if not named(parts["normalizer"], "normalizers") <= {"NFC", "NFKC", "Replace", "Lowercase"}:
            return None
        if not named(parts["pre_tokenizer"], "pretokenizers") <= {"Split", "ByteLevel"}:
            return None
        light = Tokenizer.from_file(path)
        light.normalizer, light.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        probe = [f"{a}{b}{c}" for a in "aeiouy" for b in "bdgknrstz" for c in ("", "e", "ing", "ation", "ness", "word")]
        mine = light.encode_batch_fast(probe, add_special_tokens=False)
        return light.encode_batch_fast if [_bytes(e.ids) for e in mine] == self._ids(probe) else None

    @classmethod
    def of(cls, path: str) -> WordIds:
        """This worker's memo for a file; it lasts over tasks."""
        if path not in _memos:
            _memos[path] = cls(path)
        return _memos[path]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [_bytes(e.ids) for e in self._batch(texts, add_special_tokens=False)]

    def _learn(self, chunks: Iterable[bytes]) -> None:
        """Ids of chunks, many in a call: a bar between chunks without one shows where each ends."""
        chunks = list(chunks)
        if self.bar is None:
            self.update(zip(chunks, self._ids([c.decode() for c in chunks]), strict=True))
            return
        odd = [c for c in chunks if b"|" in c]
        self.update(zip(odd, self._ids([c.decode() for c in odd]), strict=True))
        if self._letters:
            # The light copy folds no case, and texts with special tokens are not folded beforehand.
            light = [c.isalpha() and c.islower() for c in chunks]
            self._join([c for c, x in zip(chunks, light, strict=True) if x], self._letters)
            self._join([c for c, x in zip(chunks, light, strict=True) if not x and b"|" not in c], self._batch)
        else:
            self._join([c for c in chunks if b"|" not in c], self._batch)

    def _join(self, plain: list[bytes], batch: Callable) -> None:
        for at in range(0, len(plain), AT_ONCE):
            some = plain[at : at + AT_ONCE]
            ids = np.asarray(batch([b" | ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(ids == self.bar) * 4
            data = ids.tobytes()
            starts = [0, *(ends + 4).tolist()]
            self.update(zip(some, [data[a:b] for a, b in zip(starts, [*ends.tolist(), len(data)], strict=True)], strict=True))

    def _meet(self, new: set[bytes]) -> set[bytes]:
        """Learn new chunks; gives all that were added. Marks at the end of a chunk are encoded apart."""
        if not self.splits_marks:
            self._learn(new)
            return new
        parts, todo = [], set()
        for chunk in new:
            core = chunk.rstrip(MARKS)
            if core and len(core) < len(chunk) and core[-1:].isalnum():
                tail = chunk[len(core) :]
                parts.append((chunk, core, tail))
                todo.add(core)
                todo.add(tail)
            else:
                todo.add(chunk)
        todo = set(filterfalse(self.__contains__, todo))
        self._learn(todo)
        for chunk, core, tail in parts:
            self[chunk] = self[core] + self[tail]
        return new | todo

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text, given in UTF-8; null counts as empty."""
        data = [t or b"" for t in texts]
        if not self.by_chunk:
            return self._ids([d.decode() for d in data])
        if self.folds_case:  # special tokens, written <|...|>, are matched before case is folded
            data = [d if b"<|" in d else d.lower() for d in data]
        chunks = [d.split() for d in data]
        found = [list(map(self.get, c)) for c in chunks]
        gaps = [[i for i, ids in enumerate(f) if ids is None] if None in f else () for f in found]
        added = self._meet({c[i] for c, g in zip(chunks, gaps, strict=True) for i in g})
        for c, f, g in zip(chunks, found, gaps, strict=True):
            for i in g:
                f[i] = self[c[i]]
        if len(self) > MEMO_WORDS:
            for chunk in added:
                del self[chunk]
        return list(map(b"".join, found))


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = ROWS, keep: bool = False) -> Iterator[dict[str, list]]:
    """The batches' columns as lists, a few rows at a time; ``keep``: the worker's memo of words stays."""
    trim(keep)
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows).to_pydict()
