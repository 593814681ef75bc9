"""Encoding whole texts with the public byte-level BPE vocabulary, inside tasks."""

from __future__ import annotations

import base64
import ctypes
import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = r"[\t-\r\x{85}\p{Z}]"
#: A space that touches other white space; only then does a break before it change the result.
_LOOSE = f"{_SPACE} {_SPACE}|  "
#: Words that would be loose beside others.
_EDGED = f"^{_SPACE}|{_SPACE}$|^$"
_SPECIAL = "<|endoftext|>"
#: Characters that are encoded together.
_SLICE = 8_000_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def give_back() -> None:
    """Return the memory that a Python worker has freed but holds: it lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task's function that gives freed memory back when it ends."""
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return kept


def slices(texts: list[str], size: int = _SLICE) -> Iterator[list[str]]:
    """Neighbouring texts together, up to so many characters or one text."""
    held, length = [], 0
    for text in texts:
        if held and length + len(text) > size:
            yield held
            held, length = [], 0
        held.append(text)
        length += len(text)
    if held:
        yield held


@functools.cache
def _ranks(token_file: str | None) -> dict[bytes, int]:
    json_file = token_file or tokenizer_path("byte_bpe_50k.json")
    with open(re.sub(r"\.json$", ".tiktoken", json_file), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def token_bytes(token_file: str | None = None) -> np.ndarray:
    """How many bytes of text each id stands for; the special token's string follows the rest."""
    ranks = _ranks(token_file)
    size = np.zeros(max(ranks.values()) + 2, np.int64)
    size[list(ranks.values())] = [len(k) for k in ranks]
    size[-1] = len(_SPECIAL)
    return size


@functools.cache
def encoder(token_file: str | None = None) -> Callable[[list[str]], Iterator[np.ndarray]]:
    """A function from texts to the ids of each, as little-endian unsigned 32-bit numbers.

    The pattern of this vocabulary never joins a space to the word before it, so a text without
    loose white space is encoded word by word, and each distinct word of a slice only once. The
    ranks file and the tokenizer file hold one vocabulary; texts with the special token's string
    go to the latter, which knows it.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    json_file = token_file or tokenizer_path("byte_bpe_50k.json")
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN,
                              mergeable_ranks=_ranks(token_file), special_tokens={})
    id_bytes = token_bytes(token_file)
    whole = functools.cache(lambda: Tokenizer.from_file(json_file))

    def ids(text: str) -> np.ndarray:
        return np.array(plain.encode_ordinary(text), "<u4")

    def words_ids(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, each with a space before it, and where each word's begin."""
        texts = words.to_pylist()
        blank = np.flatnonzero(pc.match_substring_regex(words, _EDGED).to_numpy(
            zero_copy_only=False)).tolist()
        odd = {i: ids(" " + texts[i]) for i in blank}
        size = pc.binary_length(words.cast(pa.binary())).to_numpy(zero_copy_only=False) + 1
        size[blank] = 0
        for i in blank:
            texts[i] = None
        flat = ids("".join(" " + w for w in texts if w is not None))
        ends = np.searchsorted(np.cumsum(id_bytes[flat]), np.cumsum(size), side="right")
        starts = np.concatenate([[0], ends])
        if odd:  # put them in their places
            parts, lengths, done = [], np.diff(starts), 0
            for i in blank:
                parts += [flat[starts[done]:starts[i]], odd[i]]
                lengths[i] = len(odd[i])
                done = i
            flat = np.concatenate([*parts, flat[starts[done]:]])
            starts = np.concatenate([[0], np.cumsum(lengths)])
        return flat, starts

    def together(texts: pa.Array) -> Iterator[np.ndarray]:
        split = pc.split_pattern(texts, " ")
        offsets = split.offsets.to_numpy().tolist()
        coded = split.values.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        flat, starts = words_ids(coded.dictionary)
        length = np.diff(starts)
        for a, b in zip(offsets, offsets[1:], strict=False):
            first, mine = coded.dictionary[int(codes[a])].as_py(), codes[a + 1:b]
            n = length[mine]
            stop = np.cumsum(n)
            if len(mine):
                rest = flat[np.arange(stop[-1]) + np.repeat(starts[mine] - stop + n, n)]
            else:
                rest = flat[:0]
            yield np.concatenate([ids(first), rest]) if first else rest

    def encode(texts: list[str]) -> Iterator[np.ndarray]:
        for part in slices(texts):
            column = pa.array(part, pa.large_string())
            special = pc.match_substring(column, _SPECIAL).to_pylist()
            loose = pc.match_substring_regex(column, _LOOSE).to_pylist()
            regular = pa.array([not (x or y) for x, y in zip(special, loose, strict=True)])
            found = together(column.filter(regular)) if pc.any(regular).as_py() else iter(())
            for text, x, y in zip(part, special, loose, strict=True):
                if x:
                    yield np.array(whole().encode(text, add_special_tokens=False).ids, "<u4")
                else:
                    yield ids(text) if y else next(found)

    return encode
