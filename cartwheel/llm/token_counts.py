"""Token counts by the whole-token shortcut.

Offline, before any text is read, each string of the vocabulary is held to two proofs: the pre-tokenizer leaves it
in one piece, and merging that piece ends in the one token. The strings that pass are the whole tokens: a
pre-token among them counts one, by a look-up. Only the other pre-tokens are merged.

If the second proof holds for every string of the vocabulary, merging by pairs and merging by the rank of the
joined string are the same: wherever two neighbours join to a token, the merges below its rank have run inside
their span just as they do in that token alone, so the neighbours are its own pair. Then the faster rank merge is
used; else the library's model merges.

Counts equal the library's for byte-level BPE files: the text is cut at the special strings (one token each, as
the library does by default), and the rest is split by the file's pattern. Where a text has no two white-space
characters in a row, every pre-token lies within one space-led stretch, so stretches are counted and remembered
by themselves; other texts are split by the pattern as a whole. Characters that Python and the tokenizer may
class differently (U+001C to U+001F) send a text through the library itself.

A null text counts as empty: no bytes, no tokens. Rows are independent, so repeated ids, null ids and extra columns
play no part. The remembered stretches are bounded (``MEMORY`` entries of at most ``LONGEST`` characters).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Fixed value: the pre-tokenizer pattern of byte-level BPE files whose pre-tokenizer is ByteLevel with use_regex.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMORY = 400_000
LONGEST = 64
ODD = re.compile("[\x1c-\x1f]")
TWO_SPACES = re.compile(r"\s\s")


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes each byte as one printable character: itself, or the next unused from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xAD) and not 0x7F <= b <= 0xA0]
    spare = (chr(256 + k) for k in range(256))
    return {b: chr(b) if b in plain else next(spare) for b in range(256)}


class Memory(dict):
    """Remembers a function of a string: at most MEMORY short strings, then it starts anew."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key: str):
        value = self.function(key)
        if len(key) <= LONGEST:
            if len(self) >= MEMORY:
                self.clear()
            self[key] = value
        return value


class TokenCounter:
    """Counts tokens of whole texts as the tokenizer file at ``path`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf["pre_tokenizer"] or {}
        plain = (conf["normalizer"], conf["truncation"], conf["padding"], conf["model"]["type"], pre.get("type"))
        if plain != (None, None, None, "BPE", "ByteLevel") or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.pattern = regex.compile(PATTERN)
        special = [t["content"] for t in conf["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.alphabet = byte_alphabet()
        self.whole, self.merge = self._prove(conf["model"]["vocab"])
        self.pieces = Memory(self._merged)
        self.stretches = Memory(self._stretch)

    def _prove(self, vocabulary: dict[str, int]) -> tuple[frozenset[str], object]:
        """The whole tokens, and a rank merge if every string of the vocabulary merges to its own token."""
        import tiktoken

        back = {c: b for b, c in self.alphabet.items()}
        found: list[str] = []
        ranks: dict[bytes, int] = {}
        for piece, token in vocabulary.items():
            if not set(piece) <= back.keys():
                continue
            data = bytes(map(back.__getitem__, piece))
            if [t.id for t in self.model.tokenize(piece)] != [token]:
                continue
            ranks[data] = token
            text = data.decode("utf-8", "replace")
            if text.encode("utf-8") == data and self.pattern.findall(text) == [text]:
                found.append(text)
        by_rank = len(ranks) == len(vocabulary) and all(bytes([b]) in ranks for b in range(256))
        merge = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}) if by_rank else None
        return frozenset(found), merge

    def _merged(self, pre_token: str) -> int:
        if self.merge is not None:
            return len(self.merge.encode_ordinary(pre_token))
        return len(self.model.tokenize("".join(map(self.alphabet.__getitem__, pre_token.encode("utf-8")))))

    def _split_count(self, text: str) -> int:
        whole, merged = self.whole, self.pieces
        return sum(1 if p in whole else merged[p] for p in self.pattern.findall(text))

    def _stretch(self, stretch: str) -> int:
        """Tokens of one space and ``stretch``; letters only are one pre-token."""
        text = " " + stretch
        if text in self.whole:
            return 1
        return self._merged(text) if stretch.isalpha() else self._split_count(text)

    def _count(self, text: str) -> int:
        if not text:
            return 0
        if TWO_SPACES.search(text):
            return self._split_count(text)
        first, *rest = text.split(" ")
        return self._split_count(first) + sum(map(self.stretches.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if ODD.search(text):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        if self.special is None or not self.special.search(text):
            return self._count(text)
        return len(self.special.findall(text)) + sum(map(self._count, self.special.split(text)))


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """One counter a worker and file."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def with_token_counts(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, n_bytes and n_tokens of every row of ``docs``; ``path``: the tokenizer file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).count
        for batch in batches:
            n = pa.array([count(t) for t in batch.column("_text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep) + 1)), n], [*keep, "n_bytes", "n_tokens"]
            )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keep, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return map_arrow(rows, run, f"{kinds}, n_tokens long")
