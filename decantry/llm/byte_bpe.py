"""Byte-level BPE: encoding with the ``tokenizers`` library, decoding by its byte table.

The vocabulary writes each of the 256 bytes as one printable character. Texts are cut
before each run of white space: no match of the splitting pattern begins with something
else and goes on into white space. Each distinct part goes through the library once per
worker, and its ids and character offsets are kept. Where offsets are not asked for, words
with no more than punctuation behind them go to the library's model, which merges, without
the cutting that comes before it and costs most of the time.
"""

from __future__ import annotations

import base64
import os
import re
import string
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import sub

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_chunks

KEPT_PARTS = 500_000  # parts a worker keeps before it starts anew; bounds its memory
# What the pattern takes for white space: Python's, but for four control characters.
_PARTS = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")


def parts_of(text: str) -> list[str]:
    """The parts of a text: all join to it, but each lacks one leading space if it can.

    The first has none to lack. A part that begins with other white space, or with more
    than one space, has all of it.
    """
    parts = text.replace("\n", " \n").split(" ")
    words = text.split()
    if len(words) == len(parts) and len("".join(words)) + len(parts) - 1 == len(text):
        return parts  # there is nothing but single spaces and line ends between words
    first, *rest = _PARTS.findall(text) or [""]
    return [first, *(x[1:] if x[0] == " " and not x[1:2].isspace() else x for x in rest)]


def _whole(part: str) -> str:
    """A part with its leading space."""
    return part if part[:1].isspace() and part[0] not in "\x1c\x1d\x1e\x1f" else " " + part


@lru_cache(1)
def byte_characters() -> tuple[str, ...]:
    """The character of each byte: printable Latin-1 stands for itself, the others
    follow from U+0100 in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return tuple(chr(b) if b in plain else chr(next(others)) for b in range(256))


@lru_cache(1)
def _characters_by_byte() -> dict[int, str]:
    return dict(enumerate(byte_characters()))


def spelled(text: str) -> str:
    """A text with each of its bytes as the character that the vocabulary has for it."""
    return text.encode().decode("latin-1").translate(_characters_by_byte())


def token_bytes(token: str) -> bytes:
    """The bytes that a token of the vocabulary stands for."""
    of = _bytes_by_character()
    if all(c in of for c in token):
        return bytes(of[c] for c in token)
    return token.encode()  # a special token, which is written as it is


@lru_cache(1)
def _bytes_by_character() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_characters())}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str):
    """A tokenizer that merges as the ranks say.

    Ranks allow any two neighbours whose bytes together are a token, so each way to
    cut a token into two others becomes a merge, in the order of the tokens' ranks.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = byte_characters()
    written = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = [
        (written[t[:i]], written[t[i:]])
        for t in sorted(ranks, key=ranks.get)
        for i in range(1, len(t))
        if t[:i] in ranks and t[i:] in ranks
    ]
    vocab = {written[t]: r for t, r in ranks.items()}
    made = Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return made


@lru_cache(4)
def _tokenizer(path: str, pattern: str | None):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    if pattern is not None:
        return tokenizer_from_ranks(read_ranks(path), pattern)
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True  # in a text, their names are ordinary text
    return loaded


def _cuts_after_letters(tokenizer) -> bool:
    """Whether it cuts a space, letters and punctuation between the last two and nowhere
    else, and leaves them as they are."""
    from tokenizers import pre_tokenizers

    cut = tokenizer.pre_tokenizer
    return (
        tokenizer.normalizer is None
        and isinstance(cut, pre_tokenizers.ByteLevel)
        and cut.use_regex
        and not cut.add_prefix_space
        and all(t.special for t in tokenizer.get_added_tokens_decoder().values())
    )


class Encoder:
    """Ids and offsets of texts by one vocabulary; one per worker process."""

    def __init__(self, path: str, pattern: str | None, offsets: bool) -> None:
        self.tokenizer = _tokenizer(path, pattern)
        self.offsets = offsets
        self.by_model = not offsets and _cuts_after_letters(self.tokenizer)
        # Ids of parts, and characters from each token's start to the next one's.
        self.first_ids: dict[str, bytes] = {}
        self.first_steps: dict[str, bytes] = {}
        self.ids: dict[str, bytes] = {}
        self.steps: dict[str, bytes] = {}

    def _learn(self, parts: list[str], wholes: list[str], ids: dict, steps: dict) -> None:
        for start, end in in_chunks(wholes):
            texts, of = wholes[start:end], parts[start:end]
            if not self.offsets:
                found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
                ids.update(zip(of, [array("i", x.ids).tobytes() for x in found], strict=True))
                continue
            found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
            for part, text, x in zip(of, texts, found, strict=True):
                starts = [start for start, _ in x.offsets]
                ends = [*starts[1:], len(text)] if starts else []
                ids[part] = array("i", x.ids).tobytes()
                steps[part] = array("i", map(sub, ends, starts)).tobytes()

    def _learn_words(self, parts: list[str]) -> list[str]:
        """Learns the parts of letters with punctuation or nothing behind them; the others."""
        tokenize = self.tokenizer.model.tokenize
        others = []
        for part in parts:
            word = part.rstrip(string.punctuation)
            if not word.isalpha():
                others.append(part)
                continue
            ids = self.ids.get(word)
            if ids is None:
                found = tokenize("\u0120" + word if word.isascii() else spelled(" " + word))
                ids = array("i", [t.id for t in found]).tobytes()
            if len(word) < len(part):
                end = part[len(word) :]
                if end not in self.first_ids:
                    self.first_ids[end] = array("i", [t.id for t in tokenize(end)]).tobytes()
                ids += self.first_ids[end]
            self.ids[part] = ids
        return others

    def __call__(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each text its ids and, with offsets, the character each token starts at."""
        if len(self.ids) + len(self.first_ids) > KEPT_PARTS:
            for kept in (self.first_ids, self.first_steps, self.ids, self.steps):
                kept.clear()
        cut = [parts_of(t) for t in texts]
        firsts = [parts.pop(0) for parts in cut]
        new = list(set(firsts).difference(self.first_ids))
        self._learn(new, new, self.first_ids, self.first_steps)
        distinct: set[str] = set()
        for parts in cut:
            distinct.update(parts)
        new = list(distinct.difference(self.ids))
        if self.by_model:
            new = self._learn_words(new)
        self._learn(new, [_whole(p) for p in new], self.ids, self.steps)

        def joined(first: dict[str, bytes], later: dict[str, bytes]) -> list[np.ndarray]:
            return [
                np.frombuffer(first[a] + b"".join(map(later.__getitem__, parts)), np.int32)
                for a, parts in zip(firsts, cut, strict=True)
            ]

        if not self.offsets:
            return joined(self.first_ids, self.ids), []
        steps = joined(self.first_steps, self.steps)
        return joined(self.first_ids, self.ids), [np.cumsum(x, dtype=np.int32) - x for x in steps]


@lru_cache(4)
def encoder(path: str, pattern: str | None = None, offsets: bool = True) -> Encoder:
    """The worker's encoder, which keeps what it knows from task to task."""
    return Encoder(path, pattern, offsets)


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(a) for a in arrays)]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame, path: str, pattern: str | None = None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``ids`` and ``starts``.

    ``path`` is a ``tokenizers`` file or, with a splitting ``pattern``, a file of ranks.
    ``starts`` holds the code point at which each token begins; tokens that are parts
    of one character begin at that character. NULL and empty texts have no ids.
    Repeated rows and ids are encoded row by row; other columns are left out.
    """
    kind = docs.schema[doc_id].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, end in in_chunks(texts):
                ids, starts = encode_texts(texts[start:end])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        lists_of(ids),
                        lists_of(starts),
                    ],
                    names=["doc_id", "ids", "starts"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        work, f"doc_id {kind.simpleString()}, ids array<int>, starts array<int>"
    )


@lru_cache(4)
def byte_table(path: str, ranked: bool) -> pa.BinaryArray:
    """The bytes of each id; ids that a vocabulary leaves out have none."""
    if ranked:
        pairs = [(r, t) for t, r in read_ranks(path).items()]
    else:
        vocab = _tokenizer(path, None).get_vocab(with_added_tokens=True)
        pairs = [(i, token_bytes(t)) for t, i in vocab.items()]
    out = [b""] * (max(i for i, _ in pairs) + 1)
    for i, t in pairs:
        out[i] = t
    return pa.array(out, pa.binary())


def bytes_of(ids: pa.ListArray, table: pa.BinaryArray) -> pa.BinaryArray:
    """The bytes of each list of ids, taken from the table all at once."""
    tokens = table.take(ids.flatten())
    ends = np.cumsum(np.append(0, pc.list_value_length(ids).fill_null(0).to_numpy()))
    _, offsets, data = tokens.buffers()
    at = np.frombuffer(offsets, np.int32, len(tokens) + 1, 4 * tokens.offset)
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer(at[ends].astype(np.int32)), data]
    )


def decode(tokens: DataFrame, path: str, ranked: bool = False) -> DataFrame:
    """``tokens`` with ``bytes`` and ``decoded`` in place of ``ids``.

    ``decoded`` is the text of the bytes. Ids may begin or end in the middle of a
    character: what is no whole character reads as U+FFFD there, while ``bytes`` has
    what the ids hold. NULL ids decode to nothing, an unknown id raises.
    """
    others = [f for f in tokens.schema.fields if f.name not in ("ids", "bytes", "decoded")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(path, ranked)
        for batch in batches:
            for start in range(0, len(batch), 256):
                rows = batch.slice(start, 256)
                raw = bytes_of(rows.column("ids"), table)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(f.name) for f in others),
                        raw,
                        pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string()),
                    ],
                    names=[*(f.name for f in others), "bytes", "decoded"],
                )

    given = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in others)
    return tokens.mapInArrow(work, given + "bytes binary, decoded string")
