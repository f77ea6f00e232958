"""Token counts of whole texts by a word-level byte-pair vocabulary, with a shortcut for whole tokens.

Once in each worker the vocabulary is proved: every string that ends a word is given to the library by itself, and those
that come back as that one token form the set of whole tokens. A text is cut into blank-separated chunks and these into
pre-tokens by the library's pattern. A pre-token in the set counts 1; only the others go through the library's merges.
Chunks that occur often are remembered with their count.

Cutting with Python's tools is used where it is proved to agree with the library: the text must consist of characters
for which the library's normaliser and pattern, asked one character at a time, do the same. Any other text is
normalised and cut by the library itself, and then counted by the same shortcut. Special strings in a text are taken as
the library does by default: as one token each, found before anything is normalised.

Null and empty texts have 0 tokens. Null ids and repeated rows are rows like any other; an empty table gives no rows.
Columns other than id and text are not read.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lockgate.llm import common

LIMIT = 2048
MEMO_CHUNKS = 200_000
#: Characters tried against the library: the Latin blocks and general punctuation.
TRIED = [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), *range(0x20A0, 0x20C0)]


class Counter:
    """Counts tokens as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(Path(path).read_text())
        self.end = spec["model"]["end_of_word_suffix"] or ""
        pattern = _split_pattern(spec["pre_tokenizer"])
        self.pattern = regex.compile(pattern)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self.starts = {s[0] for s in specials}
        self.to_bytes = _byte_letters()
        self.whole = self._prove()
        self.plain = self._plain_characters()
        self.other = regex.compile("[^" + "".join(map(regex.escape, sorted(self.plain))) + "]")
        self.chunks: dict[str, int] = {}

    def _prove(self) -> frozenset[str]:
        """Vocabulary strings, in the letters of the byte level and without the word end, that encode alone as one token."""
        ids = self.library.get_vocab(with_added_tokens=False)
        names = [t[: -len(self.end)] for t in ids if self.end and t.endswith(self.end) and len(t) > len(self.end)]
        letters = {v: k for k, v in self.to_bytes.items()}
        readable, kept = [], []
        for name in names:
            try:
                readable.append(bytes(letters[c] for c in name).decode())
                kept.append(name)
            except (KeyError, UnicodeDecodeError):
                pass
        found = self.library.encode_batch(readable, add_special_tokens=False)
        return frozenset(n for n, e in zip(kept, found) if e.ids == [ids[n + self.end]])

    def _plain_characters(self) -> set[str]:
        """Characters that the library lower-cases, separates and classes as Python does."""
        normal, cut = self.library.normalizer.normalize_str, self.library.pre_tokenizer.pre_tokenize_str
        kept = set()
        for c in map(chr, TRIED):
            if unicodedata.combining(c) or not unicodedata.is_normalized("NFC", c):
                continue
            blank = c.isspace()
            if normal(c) != (" " if blank else c.lower()):
                continue
            low = c.lower()
            probe = " " if blank else low
            # beside a letter, a digit, a sign and itself
            cases = [f"a{probe}b", f"1{probe}2", f"!{probe}?", probe * 2]
            if all([t for t, _ in cut(x)] == [self._letters(p) for chunk in x.split() for p in self.pattern.findall(chunk)] for x in cases):
                kept.add(c)
        return kept

    def _letters(self, text: str) -> str:
        return "".join(self.to_bytes[b] for b in text.encode())

    def _merged(self, token: str) -> int:
        return 1 if token in self.whole else len(self.library.model.tokenize(token))

    def _chunk(self, chunk: str) -> int:
        return sum(self._merged(self._letters(p)) for p in self.pattern.findall(chunk))

    def _count(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if self.other.search(text) is None:
            known, total = self.chunks, 0
            for chunk in text.lower().split():
                n = known.get(chunk)
                if n is None:
                    n = self._chunk(chunk)
                    if len(known) < MEMO_CHUNKS:
                        known[chunk] = n
                total += n
            return total
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return sum(self._merged(token) for token, _ in cut)

    def count(self, text: str) -> int:
        if self.special is None or not any(s in text for s in self.starts):
            return self._count(text)
        total, place = 0, 0
        for found in self.special.finditer(text):
            total += self._count(text[place : found.start()]) + 1
            place = found.end()
        return total + self._count(text[place:])


def _split_pattern(spec: dict) -> str:
    """The pattern that the vocabulary's file gives for cutting words."""
    parts = spec.get("pretokenizers", [spec])
    found = [p["pattern"]["Regex"] for p in parts if p["type"] == "Split"]
    if len(found) != 1:
        raise ValueError("the tokenizer must cut words by one pattern")
    return found[0]


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row. ``path``: the vocabulary's file, on every executor."""

    def step(rows: common.Batches) -> common.Batches:
        count = counter(path).count
        for batch in common.slices(rows):
            texts = common.texts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array([count(t.decode()) for t in texts], pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(step, f"doc_id {kind}, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)
