"""Token ids of texts with a public byte-level vocabulary, in Arrow batches.

A text is cut before each single white-space character that stands between two others. The vocabulary's pattern
starts a new match there whatever stands before, so the parts can be encoded one by one and their ids kept for the next
time. The kept parts are bounded and forgotten as a whole when the bound is reached; results do not depend on them.

The ids are those of ``tokenizers`` with the .json file. Parts seen for the first time are encoded by ``tiktoken`` with
the same vocabulary as ranks, which gives equal ids in a third of the time; parts that might hold a special token's
string go to ``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import os
from array import array

import public_tokenizers

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Parts of text whose ids a worker keeps, about 200 bytes each; longer parts are not kept.
KEPT, KEPT_CHARS = 300_000, 40

_encoders: dict[tuple[str, str], "Encoder"] = {}


class _Parts(dict):
    """part -> ids as bytes of unsigned 32-bit integers; ``before`` stands before each part."""

    def __init__(self, before: str, encode):
        super().__init__()
        self.before, self.encode = before, encode

    def __missing__(self, part: str) -> bytes:
        if len(part) > 2 and part[-1] in ".," and part[-2].isalpha():
            # A run of letters ends before the mark, which ends the part: two matches in any case.
            found = self[part[:-1]] + self.encode(part[-1])
        else:
            found = self.encode(self.before + part)
        if len(part) <= KEPT_CHARS:
            self[part] = found
        return found


class Encoder:
    """Encodes texts with a vocabulary; holds what it has learned about parts of text."""

    def __init__(self, path: str, ranks: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

        def encode(part: str) -> bytes:
            if "<|" in part:
                return array("I", whole.encode(part, add_special_tokens=False).ids).tobytes()
            return array("I", fast.encode_ordinary(part)).tobytes()

        self.encode = encode
        self.bare, self.spaced = _Parts("", encode), _Parts(" ", encode)

    def _ids(self, text: str) -> bytes:
        if text.replace("\n", " ").split(" ") != text.split():
            # White space other than single spaces and line breaks between two other characters.
            return b"".join(map(self.bare.__getitem__, pieces(text)))
        out = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            out.append(self.bare[first] + b"".join(map(self.spaced.__getitem__, rest)))
        return self.encode("\n").join(out)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as unsigned 32-bit integers in the machine's (little-endian) order."""
        if len(self.bare) + len(self.spaced) > KEPT:
            self.bare.clear()
            self.spaced.clear()
        return [self._ids(t) if t else b"" for t in texts]


def pieces(text: str) -> list[str]:
    """Parts of any text that are encoded alike on their own and in it; joined they are the text.

    A cut comes before a space that has a character other than white space on both sides.
    """
    held, *rest = text.split(" ")
    out = [held]
    for word in rest:
        if held and word and not held[-1].isspace() and not word[0].isspace():
            held = " " + word
        else:
            held = out.pop() + " " + word
        out.append(held)
    return out


def encoder(path: str = VOCABULARY, ranks: str = RANKS) -> Encoder:
    """The worker's encoder for a vocabulary, given as a tokenizers file and as ranks."""
    if (path, ranks) not in _encoders:
        _encoders[path, ranks] = Encoder(path, ranks)
    return _encoders[path, ranks]
