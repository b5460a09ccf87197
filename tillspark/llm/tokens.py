"""Token ids of whole texts by byte-level pair encoding.

The vocabulary is read from a tokenizer definition in JSON.  Its ids rise with
the order of its merges, so they serve as ranks to a faster encoder of the same
kind; the ids are those of the definition.
"""

from __future__ import annotations

import json

import tiktoken

#: Fixed value: how byte-level tokenizers cut a text before they merge bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_character() -> dict[str, int]:
    """Bytes that byte-level vocabularies write as characters: printable ones as themselves, the others from U+0100 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokens:
    """Ids of texts as little-endian unsigned 32-bit numbers, and the bytes of every id.

    With ``plain``, strings of special tokens inside a text are ordinary text;
    otherwise they become their special ids.
    """

    def __init__(self, definition: str, plain: bool) -> None:
        made = json.loads(definition)
        cut = made["pre_tokenizer"] or {}
        if made["normalizer"] or cut.get("type") != "ByteLevel" or not cut.get("use_regex") or cut.get("add_prefix_space") or made["model"]["type"] != "BPE":
            raise ValueError("the definition is not a plain byte-level pair encoding")
        of = byte_of_character()
        ranks = {bytes(of[c] for c in piece): number for piece, number in made["model"]["vocab"].items()}
        special = {t["content"]: t["id"] for t in made["added_tokens"]}
        self.encoder = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.allowed = set() if plain else set(special)
        self.bytes_of = [b""] * (1 + max([*ranks.values(), *special.values()]))
        for piece, number in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.bytes_of[number] = piece

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.encoder.encode_to_numpy(t, allowed_special=self.allowed, disallowed_special=()).tobytes() for t in texts]
