"""Token ids of whole texts through the tokenizers library, one distinct piece at a time.

Both kinds of tokenizer used here never join characters across certain blanks,
so a text falls into pieces whose ids simply follow one another. Each distinct
piece is encoded once per worker and looked up from then on. A full stop or
comma after a letter or digit opens a pre-token in both kinds, so it opens a
piece as well.

* Tokenizers whose normalizer turns white space into a blank and whose
  pre-tokenizer drops it: pieces lie between blanks.
* Byte-level tokenizers without a normalizer: a piece begins at each blank that
  a visible character follows, because such a blank always opens a pre-token.

Pieces of characters below U+0250, where lower case is all that the normalizer
changes, are split by the tokenizer's own pattern and go straight to its merge
model; all others take the library's full path. So does a whole text that holds
the spelling of an added token, because the library looks for those before
anything else.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct

import public_tokenizers
import regex

#: Pieces of the present and of the past generation that one worker remembers, about 200 bytes each. Only speed depends on it.
REMEMBERED = 600_000
#: At most one blank, then visible characters below U+0250 whose lower case is one letter.
PLAIN = re.compile("[ ]?[\x21-\x7e\xa1-\u012f\u0131-\u024f]+").fullmatch
BEYOND = re.compile("[\u0130\u0250-\U0010ffff]").search
LETTERS = "a-zA-Z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f"
#: A full stop or comma that follows no letter or digit.
ODD_STOP = re.compile(f"[,.](?<![{LETTERS}0-9].)").search
#: One pre-token of either kind.
ONE_WORD = re.compile(f"[ ]?[{LETTERS}]+").fullmatch
PACK = [struct.Struct(f"<{n}I").pack for n in range(64)]
#: Blanks beside other white space, or the mark that stands for a cut.
ODD_BLANK = re.compile(" [ \t-\r\x1c-\x1f\x85]|\0").search
OPENS = re.compile(r"(?= [^\s\x1c-\x1f\x85])")


class _ByteNames(dict):
    """Each character's spelling in the byte-level alphabet, asked from the library once."""

    def __init__(self, spell) -> None:
        super().__init__()
        self.spell = spell

    def __missing__(self, code: int) -> str:
        self[code] = "".join(part for part, _ in self.spell(chr(code)))
        return self[code]


class TextEncoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.remembered = remembered
        with open(path) as file:
            spec = json.load(file)
        self.between_blanks = spec["normalizer"] is not None
        pattern = public_tokenizers.PATTERN
        if self.between_blanks:
            splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
            pattern = splits[0]["pattern"]["Regex"]
        self.pre_tokens = regex.compile(pattern).findall
        plain = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.names = _ByteNames(plain.pre_tokenize_str)
        self.added = [token["content"] for token in spec["added_tokens"]]
        self.added_folded = [token["content"].lower() for token in spec["added_tokens"] if token["normalized"]]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if self.between_blanks:
            if not BEYOND(text):
                text = text.lower()
            text = text.replace("\n", " ").replace("\t", " ")
            if not ODD_STOP(text):
                text = text.replace(",", " ,").replace(".", " .")
            return text.split(" ")
        if ODD_BLANK(text):
            return OPENS.split(text)
        text = text.replace(" ", "\0 ")
        if not ODD_STOP(text):
            text = text.replace(",", "\0,").replace(".", "\0.")
        return text.split("\0")

    def by_library(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def merged(self, pre_token: str) -> bytes:
        if pre_token.isascii():
            spelled = self.names[32] + pre_token[1:] if pre_token[0] == " " else pre_token
        else:
            spelled = pre_token.translate(self.names)
        found = [token.id for token in self.model.tokenize(spelled)]
        return PACK[len(found)](*found) if len(found) < len(PACK) else struct.pack(f"<{len(found)}I", *found)

    def ids(self, piece: str) -> bytes:
        if not piece:
            return b""
        if not PLAIN(piece):
            return self.by_library(piece)
        if self.between_blanks:
            piece = piece.lower()
        if ONE_WORD(piece):
            return self.merged(piece)
        return b"".join(map(self.merged, self.pre_tokens(piece)))

    def has_added(self, text: str) -> bool:
        """Whether the text spells an added token."""
        if any(content in text for content in self.added):
            return True
        return bool(self.added_folded) and any(content in text.lower() for content in self.added_folded)

    def encode(self, text: str) -> bytes:
        if self.has_added(text):
            return self.by_library(text)
        known, older = self.known, self.older
        pieces = self.pieces(text)
        found = list(map(known.get, pieces))
        at = 0
        while True:
            try:
                at = found.index(None, at)
            except ValueError:
                break
            piece = pieces[at]
            ids = known.get(piece)
            if ids is None:
                ids = older.get(piece)
                known[piece] = ids = self.ids(piece) if ids is None else ids
            found[at] = ids
        if len(known) > self.remembered:
            self.older, self.known = known, {}
        return b"".join(found)


@functools.cache
def encoder(name_or_path: str) -> TextEncoder:
    """One encoder per worker and tokenizer; a bare name is looked up among the public ones."""
    path = name_or_path if os.path.sep in name_or_path else public_tokenizers.path(name_or_path)
    return TextEncoder(path)
