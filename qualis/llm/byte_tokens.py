"""Ids of the public byte-level BPE tokenizer, fast where both libraries must agree.

``tokenizers`` defines the result.  A text of ASCII and U+00C0-U+00FF letters,
without control characters, without ``<|`` and without very long runs is cut
the same way by ``tiktoken`` (same pattern, same vocabulary as ranks), which is
several times faster; every other text goes to ``tokenizers`` itself.  Tests
hold both against each other.
"""

from __future__ import annotations

import base64
import os
from array import array

import numpy as np
import pyarrow as pa

from qualis.llm import text as T

JSON, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
RUN = 200  # bytes without a plain space from which a text goes to ``tokenizers``

# Byte classes: 0 plain, 1 lead byte of U+00C0-U+00FF, 2 its second byte, 3 anything else
_KIND = np.full(256, 3, np.uint8)
_KIND[32:127] = 0
_KIND[10] = 0
_KIND[0xC3] = 1
_KIND[0x80:0xC0] = 2


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path(JSON), public_tokenizers.path(RANKS)


def plain_texts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts of a slice both libraries cut alike."""
    kind = _KIND[raw]
    bad = kind == 3
    if len(raw):
        lead = kind[:-1] == 1
        bad[1:] |= (kind[1:] == 2) != lead  # a second byte follows a lead byte, nothing else does
        bad[0] |= kind[0] == 2
        bad[-1] |= kind[-1] == 1
        bad[1:] |= lead & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        bad[:-1] |= (raw[:-1] == 60) & (raw[1:] == 124)
        bad[:-1] |= (raw[:-1] == 32) & (raw[1:] == 32)
        bad[:-1] |= (raw[:-1] == 10) & (raw[1:] == 10)
    s, e = T.spans(raw, offsets)
    bad[s[e - s > RUN]] = True
    return T.row_sums(bad, offsets) == 0


class ByteIds:
    """Token ids of texts; ``plain_specials`` takes special tokens' strings as plain text."""

    def __init__(self, json_path: str, ranks_path: str, plain_specials: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tool = Tokenizer.from_file(json_path)
        self.tool.encode_special_tokens = plain_specials
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        special = {i: t.encode() for t, i in self.tool.get_vocab().items() if i >= len(ranks)}
        self.token_bytes = [b for b, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.token_bytes += [special[i] for i in sorted(special)]

    def encode(self, raw: np.ndarray, offsets: np.ndarray, prefix: str = "") -> list[np.ndarray]:
        """uint32 ids of prefix + text for every text of a slice."""
        data = raw.tobytes()
        plain = plain_texts(raw, offsets)
        texts = [prefix + data[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        out: list = [np.asarray(array("I", self.fast.encode_ordinary(t))) if p else None
                     for t, p in zip(texts, plain.tolist(), strict=True)]
        rest = np.flatnonzero(~plain).tolist()
        for i, x in zip(rest, self.tool.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(x.ids, np.uint32)
        return out


_LOADED: dict[tuple, ByteIds] = {}


def loaded(json_path: str, ranks_path: str, plain_specials: bool) -> ByteIds:
    key = (json_path, ranks_path, plain_specials)
    if key not in _LOADED:
        _LOADED[key] = ByteIds(*key)
    return _LOADED[key]


def joined(batches, limit: int = T.SLICE):
    """Arrow batches put together (column 1 is the text) up to ``limit`` bytes of text."""
    held, size = [], 0
    for b in batches:
        if b.num_rows == 0:
            continue
        held.append(b)
        size += b.column(1).nbytes
        if size >= limit:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
