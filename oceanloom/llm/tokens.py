"""Ids of public tokenizers, by the faster of the libraries that hold the same vocabulary.

``tokenizers`` is the measure for the byte-level vocabulary; the rank library gives the same ids for every code point
and splits (tests compare them), at a fifth of the time, but its pattern recurses on long white space.  Such texts go
through ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

#: White space from which a text goes through ``tokenizers``.
LONG_SPACE = re.compile(r"\s{4096}")
#: Units of the piece vocabulary that are kept: how many, and how long at most.
KEPT_UNITS, KEPT_LENGTH = 1 << 17, 48


def byte_encoder(vocabulary: str, ranks: str, special: bool) -> Callable[[str], list[int]]:
    """A function from text to ids of the byte-level vocabulary; ``special`` says whether strings of special tokens become these."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    exact.encode_special_tokens = not special
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        if (special and "<|" in text) or LONG_SPACE.search(text):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def byte_tokens(vocabulary: str) -> list[bytes]:
    """The bytes of each id: the entry's characters stand for bytes as byte-level vocabularies write them."""
    from tokenizers import Tokenizer

    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # these stand for themselves, the others from U+0100 on
    byte_of = {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    vocab = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for entry, k in vocab.items():
        out[k] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return out


def piece_tokens(model) -> list[bytes]:
    """The bytes of each piece: U+2581 is a space, <0xHH> a byte."""
    return [bytes([int(p[3:5], 16)]) if model.is_byte(k) else p.replace("▁", " ").encode() for k, p in ((k, model.id_to_piece(k)) for k in range(model.get_piece_size()))]


def piece_encoder(model, tokens: list[bytes]) -> Callable[[str], list[int] | None]:
    """A function from text to piece ids, or None where their bytes don't give a space and the text.

    No piece of the vocabulary goes on from another character to a space, so merges stay within units of spaces and what
    follows them, and a unit has the same ids wherever it stands; common units are looked up.  A vocabulary with such a
    piece is used on whole texts.
    """
    whole = any("▁" in model.id_to_piece(k).lstrip("▁") for k in range(model.get_piece_size()))
    known: dict[str, list[int] | None] = {}

    def fresh(unit: str) -> list[int] | None:
        ids = model.encode(unit[1:]) if len(unit) > 1 else [model.piece_to_id("▁")]  # the empty text gets no space before it
        ids = ids if b"".join([tokens[k] for k in ids]) == unit.encode() else None
        if len(unit) <= KEPT_LENGTH:
            if len(known) >= KEPT_UNITS:
                known.clear()
            known[unit] = ids
        return ids

    def encode(text: str) -> list[int] | None:
        spaced, out = " " + text, []
        if whole:
            return fresh(spaced)
        for unit in re.findall(" +[^ ]*", spaced):
            ids = known.get(unit, ...)
            if ids is ...:
                ids = fresh(unit)
            if ids is None:
                return None
            out += ids
        return out

    return encode
