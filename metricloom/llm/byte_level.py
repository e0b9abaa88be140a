"""Byte-level vocabularies: the bytes of their tokens, and a quicker library where it is safe."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import public_tokenizers

Encode = Callable[[list[str]], list[list[int]]]

#: Characters that both libraries' pattern classes agree on beyond doubt.
_LATIN = re.compile("[\x00-ɏ]*").fullmatch
#: A longer run of white space overflows the stack of the quicker library.
BLANKS = 10_000
_LONG_BLANK = re.compile(rf"\s{{{BLANKS}}}").search


def byte_characters() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in kept}
    return table | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id; added tokens have none."""
    alphabet = byte_characters()
    table = [b""] * (max(tokenizer.get_vocab(with_added_tokens=True).values()) + 1)
    for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
        table[i] = bytes(alphabet[c] for c in token)
    return table


def is_plain(spec: dict) -> bool:
    """Whether nothing but the pattern and the merges shapes the tokens, and ids follow the order of the merges."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model["type"] == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex")
        and not before.get("add_prefix_space") and not spec.get("normalizer")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    )
    if not plain:
        return False
    vocabulary, merges = model["vocab"], model["merges"]
    if len(vocabulary) != 256 + len(merges) or {t for t, i in vocabulary.items() if i < 256} != set(byte_characters()):
        return False
    merged = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
    return all(vocabulary.get(token) == 256 + k for k, token in enumerate(merged))


def quick(spec: dict, table: Sequence[bytes], library: Encode, special: Sequence[str] = ()) -> Encode:
    """``library``, the file's own one, for a file that ``is_plain``; several times as fast.

    The same vocabulary and merges go to another library. Its pattern classes come from other
    tables, so texts beyond Latin letters go to the file's own library, as do those with a very
    long run of white space and those that hold one of the ``special`` strings.
    """
    import tiktoken

    ranks = {table[i]: i for i in spec["model"]["vocab"].values()}
    other = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def safe(text: str) -> bool:
        return (
            bool(text.isascii() or _LATIN(text))
            and not (len(text) >= BLANKS and _LONG_BLANK(text))
            and not any(s in text for s in special)
        )

    def encode(texts: list[str]) -> list[list[int]]:
        out: list = [other.encode_ordinary(x) if safe(x) else None for x in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, library([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    return encode
